"""Registered queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollmill.catalog import datasets, grouped, language, monitors, pairs, streams
from rollmill.catalog.entries import Entry

FAMILIES = (datasets, language, pairs, grouped, monitors, streams)


def entries() -> dict[str, Entry]:
    found: dict[str, Entry] = {}
    for family in FAMILIES:
        for name, entry in family.ENTRIES.items():
            if name in found:
                raise ValueError(f"two queries are named {name}")
            found[name] = entry
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: e.build for name, e in entries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: e.sql for name, e in entries().items() if e.sql}
