"""Every catalog query against its DuckDB SQL on the driver tables."""

import pytest

import __spark_entry__ as E
from tidemark.plans.catalog import QUERIES
from tools.compare import compare

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, name):
    res = compare(spark, SF, [name])[name]
    assert res["cols"], res
    assert res["match"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "rank", "item_id", "view_count"]
    assert df.count() > 0


def test_all_queries_without_broadcast_or_adaptive(spark):
    """The plans a large run uses (sort-merge joins, no adaptive re-planning) give the same answers."""
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        res = compare(spark, SF, sorted(QUERIES))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert [k for k, v in res.items() if not v["match"]] == []
