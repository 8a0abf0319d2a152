"""Scoring counts the n-grams once, needed pairs among them (F4, F9, F10, F14, F15 of round 3)."""

from pyspark.sql import functions as F

from rollmill.operators import ngram as L


def test_scoring_counts_once_and_joins_no_ngrams(spark):
    docs = spark.createDataFrame([(1, "a b a c"), (2, "b a d"), (3, "a b")], "doc_id bigint, text string")
    lm = L.fit_ngram_lm(docs, "text", {"one": F.lit(True), "two": F.col("doc_id") < 3})
    samples = spark.createDataFrame([(1, "a b zzz"), (2, "zzz a"), (3, None)], "sample_id bigint, response string")
    found = L.token_logp(lm, samples, ["sample_id"], prompt=None, entropy=True)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Generate") == 1  # the samples' words; documents were split before
    needed = samples.select(F.explode(F.array(F.struct(F.lit("a").alias("ctx"), F.lit("b").alias("w")), F.struct(F.lit("q").alias("ctx"), F.lit("b").alias("w")))).alias("p")).select("p.*")
    apart = L.score_ngrams(L.replace(lm, rows=None), needed, entropy=True)
    assert sorted(map(tuple, L.score_ngrams(lm, needed, entropy=True).collect())) == sorted(map(tuple, apart.collect()))
    assert found.count() == 5
