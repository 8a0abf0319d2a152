"""Tokens and counts meet in one shuffle, logs in none (F2 of round 4)."""

import pytest
from pyspark.sql import functions as F

from rollmill.catalog import language as C
from rollmill.operators import ngram as L

IDS = ["sample_id"]
DOCS = [
    (1, "a b a c", 1), (2, "b  a\td A", None), (3, "a b", None), (4, None, 1), (5, "", 1), (6, "a b é a b", 1), (6, "a b", 1), (6, "a b", 1),
    (None, "<s> a b", 1), (7, "a b\nb a\nc d", 1), (8, "a b zzz", 0), (9, "zzz q\na b", 0), (10, "a b\n", 1), (11, "a\nb", 0), (12, "only here", None),
]


def documents(spark):
    """The model reads those of kind 1 and NULL, those of kinds 0 and 1 are scored."""
    docs = spark.createDataFrame(DOCS, "sample_id bigint, text string, kind int")
    return docs.withColumn("_cut", C.cut("text"))


def model(spark, n=2, **scored):
    read = F.coalesce(F.col("kind"), F.lit(1)) == 1
    return L.fit_ngram_lm(documents(spark), "text", {"one": read, "two": read & (F.col("sample_id") < 7)}, n, **scored)


def own(spark, n=2):
    return model(spark, n, ids=[*IDS, "_cut"], scored=F.col("kind").isNotNull())


def samples(spark):
    return documents(spark).where("kind is not null").withColumnRenamed("text", "response")


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("n", [1, 2, 3])
@pytest.mark.parametrize("hot, parts", [(1 << 20, None), (4, None), (0, None), (1 << 20, 7), (4, 7)])
def test_own_documents_score_the_same(spark, monkeypatch, n, hot, parts):
    monkeypatch.setattr(L, "GATHER_HOT", hot)
    if parts:
        monkeypatch.setattr(L, "GATHER_ROWS", 5)
    apart = L.token_logp(model(spark, n), samples(spark), [*IDS, "_cut"], prompt=None)
    assert rows(L.token_logp(own(spark, n), None, [*IDS, "_cut"])) == rows(apart)


def test_own_documents_take_one_shuffle_and_logs_none(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    assert exchanges(C.two_logs(model(spark), samples(spark), IDS, None, "lp_one", "lp_two")) == 0
    found = L.token_logp(own(spark), None, [*IDS, "_cut"])
    assert exchanges(found) == 1
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("RepartitionByExpression") == 1 and text.count("Generate") == 1
    for lm, ids, entropy in ((own(spark), IDS, False), (own(spark), [*IDS, "_cut"], True), (model(spark), [*IDS, "_cut"], False)):
        with pytest.raises(ValueError):
            L.token_logp(lm, None, ids, entropy=entropy)


def test_two_logs_are_the_same_by_either_way(spark):
    apart = C.two_logs(model(spark), samples(spark), IDS, None, "lp_one", "lp_two")
    found = C.two_logs(own(spark), None, IDS, None, "lp_one", "lp_two")
    assert rows(found) == rows(apart) and {r.sample_id for r in found.collect()} == {1, 6, 7, 8, 9, 10, 11}


def test_marked_documents(spark, root):
    from rollmill.sources import fixtures as fx

    marked = fx.labelled_documents(spark, root, "labelled").where("labelled").select("doc_id", "text")
    assert rows(marked) == rows(fx.doc_rollouts(spark, root).selectExpr("sample_id as doc_id", "response as text"))
