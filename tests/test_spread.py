"""Tasks that follow the data: groups and keys that grow with it stay small in each task."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F
from rows import as_set, signals

from depotlens.operators.measures import merged_parts, rollup
from depotlens.operators.quality import expect_or_drop
from depotlens.operators.states import DISPATCH, EXACT_STATES
from depotlens.operators.serving import decision_counts
from depotlens.plans.registry import QUERIES, _decision_inputs, _priced
from depotlens.plans.reports import ranked_summary
from depotlens.sources import signals as module


def dealt_to(result) -> dict[str, set[int]]:
    """Partitions of the plan's hash shuffles, by whether a number was asked for."""
    text = result._jdf.queryExecution().executedPlan().toString()
    found = {"REPARTITION_BY_NUM": set(), "ENSURE_REQUIREMENTS": set()}
    for keys, number, origin in re.findall(r"hashpartitioning\(([^\n]*), (\d+)\), (\w+)", text):
        if "o_custkey" not in keys and "c_custkey" not in keys:
            found[origin].add(int(number))
    return found


@pytest.fixture
def many_tasks(data, monkeypatch) -> int:
    """Tasks of so few bytes that the test's tables take more than a shuffle of the session."""
    monkeypatch.setattr(module, "BYTES_PER_TASK", 10_000)
    return -(-os.path.getsize(f"{data}/lineitem.parquet") // 10_000)


def test_lines_and_wide_lanes_of_exact_dispatch(spark, data, many_tasks):
    assert module.line_tasks(spark, data) == many_tasks > 4
    found = QUERIES["exact_dispatch"](spark, data)
    # no shuffle of the lines or of what grows like them is left to the session's number
    assert dealt_to(found) == {"REPARTITION_BY_NUM": {many_tasks}, "ENSURE_REQUIREMENTS": set()}
    direct = EXACT_STATES["silver_dispatch_context"].from_signals(_priced(spark, data, wide=True))
    assert as_set(found) == as_set(direct)


def test_small_tables_are_left_to_the_session(spark, data):
    assert not dealt_to(QUERIES["exact_dispatch"](spark, data))["REPARTITION_BY_NUM"]


@pytest.mark.parametrize("tasks", [0, 7])
def test_shares_count_hot_lanes_nulls_and_repeats(spark, tasks):
    rows = [{"id": k, "retail_location_id": f"L{k % 500}", "freight_cost": None if k % 3 else k / 7} for k in range(1500)]
    rows += [{"route_id": None, "retail_location_id": v} for v in ("L1", "L1", None, "L2")]
    rows += [{"route_id": "alone", "retail_location_id": None, "freight_cost": None}]
    whole, shared = signals(spark, *rows), DISPATCH.exactly().by_shares()
    direct = DISPATCH.exactly().from_signals(whole)
    rolled = rollup(whole, [shared], tasks)
    found = shared.from_shares(rolled, tasks)
    assert as_set(found) == as_set(direct) and found.dtypes == direct.dtypes
    halves = [rollup(whole.where(F.col("id") % 2 == k), [shared], tasks) for k in range(2)]
    merged = merged_parts(halves[0].unionAll(halves[1]), [shared], tasks)
    assert as_set(shared.from_shares(merged, tasks)) == as_set(direct)
    if tasks:  # the values of a hot lane are spread
        sizes = [r["count"] for r in rolled.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == tasks and max(sizes) < 250


def test_lanes_of_dispatch_context_wide(spark, data, many_tasks):
    found = QUERIES["dispatch_context_wide"](spark, data)
    assert dealt_to(found) == {"REPARTITION_BY_NUM": {many_tasks}, "ENSURE_REQUIREMENTS": set()}
    bronze = expect_or_drop(module.signals_from(spark, data, wide=True))
    assert as_set(found) == as_set(DISPATCH.from_signals(bronze))


def test_positions_and_lanes_of_decision_summary_wide(spark, data, many_tasks):
    found = QUERIES["decision_summary_wide"](spark, data)
    numbers = dealt_to(found)
    # what is left to the session are counts by market and flags
    assert numbers["REPARTITION_BY_NUM"] == {many_tasks} and numbers["ENSURE_REQUIREMENTS"] <= {4}
    text = found._jdf.queryExecution().executedPlan().toString()
    left = re.findall(r"hashpartitioning\(([^\n]*), \d+\), ENSURE", text)
    assert not any(key in keys for keys in left for key in ("l_orderkey", "terminal_id", "product_id", "route_id"))
    counts = {tuple(r) for r in found.collect()}
    inputs = _decision_inputs(spark, data, wide=True)
    assert counts == {tuple(r) for r in ranked_summary(decision_counts(*inputs)).collect()}


def test_narrow_groups_are_aggregated_before_they_are_shuffled(spark, data, many_tasks):
    """Hot groups stay spread: only the lines and their orders are dealt by number."""
    text = QUERIES["decision_summary"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert {k.split("#")[0] for k in re.findall(r"hashpartitioning\(([^\n]*), \d+\), REPARTITION_BY_NUM", text)} == {"l_orderkey", "o_orderkey"}


def test_lanes_of_incremental_dispatch_wide(spark, data, many_tasks):
    found = QUERIES["incremental_dispatch_wide"](spark, data)
    assert dealt_to(found) == {"REPARTITION_BY_NUM": {many_tasks}, "ENSURE_REQUIREMENTS": set()}
    bronze = expect_or_drop(module.signals_from(spark, data, wide=True))
    assert as_set(found) == as_set(DISPATCH.exactly().from_signals(bronze))


def test_a_bitmap_takes_as_little_as_its_values(spark):
    """Bitmaps are integers that aggregates update in place, so lanes of one location each
    take no more than rows of them."""
    state = DISPATCH.by_bitmaps()
    rows = signals(spark, *({"id": k, "route_id": f"R{k % 9}"} for k in range(60)))
    numbered = rows.withColumn("retail_location_id__number", F.when(F.col("id") % 10 > 0, F.col("id") * 3 + (1 << 46)))
    rolled = rollup(numbered, [state])
    merged = merged_parts(rolled.unionAll(rolled), [state], 7)
    for one in (rolled, merged):
        assert dict(one.dtypes)["retail_location_id__bits"] == "bigint"
        assert "SortAggregate" not in one._jdf.queryExecution().executedPlan().toString()
    assert merged.count() == rolled.count() <= 9 * (3 + 1)
    wanted = numbered.groupBy("route_id").agg(F.count_distinct("retail_location_id__number").alias("n"))
    for found in (state.from_rollup(merged), state.from_shares(merged, 7)):
        assert as_set(found.select("route_id", "served_location_count")) == as_set(wanted)
