"""Every registered query against its SQL twin on the given tables."""

import pytest

import __spark_entry__ as spec
import check
from rollmill import catalog

ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(root):
    return check.oracle_connection(root)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, root, name):
    assert con.sql(ORACLES[name]).limit(1).fetchall(), "an empty result proves nothing"
    assert check.difference(spec.queries()[name](spark, root), con.sql(ORACLES[name])) is None


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(ORACLES)))
def test_queries_without_sql_give_rows(spark, root, name):
    assert spec.queries()[name](spark, root).count() > 0


def test_the_comparison_notices_a_wrong_value(spark, con, root):
    query = spec.queries()["a1_group_stats"](spark, root)
    wrong = ORACLES["a1_group_stats"].replace("avg(reward) as mu", "avg(reward) + 0.001 as mu")
    assert "rows differ" in check.difference(query, con.sql(wrong))


def test_entry_has_one_row_per_run(spark):
    report = spec.entry(spark)
    assert report.count() == 5
    assert report.columns == ["run_id", "groups", "no_signal_share", "accuracy", "mean_abs_adv"]
