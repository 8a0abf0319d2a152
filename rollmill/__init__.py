"""Rollouts, preferences and log-probs as Spark DataFrames."""
