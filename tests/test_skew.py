"""Hot keys and join strategies of large data: the answers stay the same."""

from __future__ import annotations

import pytest
from compare import assert_same, connect
from pyspark.sql import functions as F

from depotlens.operators.fanout import block_grid, block_tasks

from depotlens.plans.oracle import ORACLE
from depotlens.plans.registry import QUERIES

SKEWED = {
    # a third of all lines in one order, a third of all lines from one supplier
    "lineitem": """
        SELECT * REPLACE (
            CASE WHEN l_partkey % 3 = 0 THEN (SELECT min(o_orderkey) FROM orders WHERE o_orderkey % 97 > 0) ELSE l_orderkey END AS l_orderkey,
            CASE WHEN l_suppkey % 3 = 0 THEN 6 ELSE l_suppkey END AS l_suppkey)
        FROM lineitem""",
    # half of all orders by one customer, a third of all customers in one nation
    "orders": """
        SELECT * REPLACE (
            CASE WHEN o_orderkey % 2 = 0 THEN (SELECT min(c_custkey) FROM customer) ELSE o_custkey END AS o_custkey)
        FROM orders""",
    "customer": """
        SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 3 ELSE c_nationkey END AS c_nationkey)
        FROM customer""",
}

# nothing is broadcast, and every partition counts as skewed and is split
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
}


@pytest.fixture(scope="module")
def skewed(data, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    with connect(data) as duck:
        for name, query in SKEWED.items():
            duck.execute(f"COPY ({query}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder


@pytest.fixture
def large(spark):
    for name, value in LARGE.items():
        spark.conf.set(name, value)
    yield
    for name in LARGE:
        spark.conf.unset(name)


CHECKED = (
    "bronze_signals", "inventory_state", "demand_drivers", "dispatch_context",
    "planner_explainability", "decisions", "decision_summary", "signals_by_source",
)


@pytest.mark.parametrize("name", CHECKED)
def test_hot_keys(spark, skewed, large, name):
    with connect(skewed) as duck:
        expected = duck.execute(ORACLE[name]).df()
    assert_same(QUERIES[name](spark, skewed), expected)


@pytest.mark.parametrize("name", ["decisions", "decision_summary", "dispatch_exposure"])
def test_no_broadcast(spark, data, large, name):
    with connect(data) as duck:
        expected = duck.execute(ORACLE[name]).df()
    assert_same(QUERIES[name](spark, data), expected)


@pytest.mark.parametrize(
    ("lefts", "rights"),
    [(10**6, 10**6), (10**6, 100), (100, 10**6), (10**5, 10**5), (3, 10**7), (2001, 2000)],
)
def test_blocks_copy_little(spark, lefts, rights):
    """Copies of both sides stay near those of a square grid, and no block is too large."""
    block = 4_000_000
    counts = spark.createDataFrame([(lefts, rights)], "l bigint, r bigint")
    strips, bands = counts.select(*block_grid(F.col("l"), F.col("r"), block)).first()
    assert 1 <= strips <= lefts and 1 <= bands <= rights
    assert -(-lefts // strips) * -(-rights // bands) <= 1.5 * block
    blocks = -(-lefts * rights // block)
    bands_best = min(max((blocks * rights / lefts) ** 0.5, 1), rights, blocks)
    best = lefts * bands_best + rights * max(blocks / bands_best, 1)
    assert lefts * bands + rights * strips <= 2 * best


def test_tasks_follow_the_pairs(spark):
    left = spark.range(1000).select(F.lit("M").alias("market_key"))
    right = spark.range(500).select(F.lit("M").alias("market_key"))
    assert block_tasks(left, right, "market_key", 100_000) == 5
    assert block_tasks(left, right.limit(0), "market_key") == 1
