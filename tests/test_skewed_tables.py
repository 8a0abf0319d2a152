"""Queries over tables where one order, one text and one conversation own a third of the rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spec
import check
from rollmill.sources import fixtures as fx

HOT = {
    "lineitem": "select * replace (case when n % 3 = 0 then 5 else l_orderkey end as l_orderkey)",
    "documents": "select * replace (case when n % 3 = 0 then 'the same words again and again' else text end as text)",
    "conversations": "select * replace (case when n % 3 = 0 then 1 else conv_id end as conv_id,"
    " case when n % 3 = 0 then 100 + 7 * n else turn end as turn)",
}


@pytest.fixture(scope="module")
def hot_root(root, tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    con = duckdb.connect()
    for name in ("orders", "lineitem", "documents", "labels", "conversations", "events", "embeddings"):
        source = f"select *, row_number() over () as n from '{root}/{name}.parquet'"
        body = HOT.get(name, "select *")
        con.sql(f"copy (select * exclude (n) from ({body} from ({source}))) to '{folder}/{name}.parquet' (format parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def con(hot_root):
    return check.oracle_connection(hot_root)


@pytest.mark.parametrize(
    "name",
    [
        "a1_group_stats", "a4_adv_grpo", "a6_adv_rloo", "a7_ema_baseline", "a10_dynamic_sampling", "a11_gae",
        "d2_top_k_per_prompt", "d5_best_worst_pairs", "l1_fit_ngram_lm", "l3_seq_logp", "o9_ratio_report",
        "p5_kto_loss", "s1_sft_examples", "s6_validate_pairs", "m6_step_report",
    ],
)
def test_same_rows_as_sql(spark, con, hot_root, name):
    sql = spec.oracle_sql()[name]
    assert check.difference(spec.queries()[name](spark, hot_root), con.sql(sql)) is None


def test_samples_of_the_hot_order_are_numbered_in_blocks(spark, hot_root):
    lines = fx.samples(spark, hot_root).where("l_orderkey = 5")
    n = lines.count()
    assert n > 2000 and sorted(r.sample_id for r in lines.collect()) == list(range(n))
    assert lines.groupBy("l_linenumber", F.shiftright("l_partkey", 10)).count().agg(F.max("count")).first()[0] < n / 2
