"""Two logs of the same samples come out of one scoring (F1, F2 of round 3)."""

from pyspark.sql import functions as F

from rollmill.catalog import language as C
from rollmill.operators import ngram as L
from rollmill.operators import objectives as O

IDS = ["sample_id"]


def test_two_logs_score_each_token_once(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b a c"), (2, "b a d"), (3, "a b")], "doc_id bigint, text string")
    lm = L.fit_ngram_lm(docs, "text", {"one": F.lit(True), "two": F.col("doc_id") < 3})
    rows = [(1, "a b\nb a\nc d"), (2, "a b c"), (3, ""), (4, None), (5, "\nb a"), (6, "a b\n"), (7, "a\nb"), (7, "a\nb")]
    samples = spark.createDataFrame(rows, "sample_id bigint, response string")

    def log(texts, lp):
        order = F.sort_array(F.collect_list(F.struct("pos", lp)))
        return L.token_logp(lm, texts, IDS, prompt=None).groupBy(*IDS).agg(F.transform(order, lambda t: t[lp]).alias(lp))

    short = samples.withColumn("response", F.regexp_replace("response", C.LAST_LINE, ""))
    apart = O.zip_logs(log(samples, "lp_one"), log(short, "lp_two"), "lp_one", "lp_two", IDS)
    apart = sorted(map(tuple, apart.collect()))

    calls = []
    scored = L.token_logp
    monkeypatch.setattr(L, "token_logp", lambda *a, **k: calls.append(a) or scored(*a, **k))
    found = C.two_logs(lm, samples, IDS, None, "lp_one", "lp_two")
    assert sorted(map(tuple, found.collect())) == apart
    assert {r[0] for r in apart} == {1, 2, 6, 7}
    assert len(calls) == 1
