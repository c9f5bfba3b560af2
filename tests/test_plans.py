"""What the physical plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import DataFrame

from depotlens.operators import states
from depotlens.plans import reports
from depotlens.plans.graph import build_all
from depotlens.plans.registry import QUERIES
from depotlens.schema import GOLD
from depotlens.sources.signals import signals_from


def plan(frame: DataFrame) -> str:
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def stored(spark, data, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bronze"))
    signals_from(spark, data).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def columns_read(text: str) -> list[set[str]]:
    found = re.findall(r"ReadSchema: struct<(.*)>", text)
    return [{part.split(":")[0] for part in schema.split(",")} for schema in found]


def test_dispatch_reads_only_its_columns(stored):
    bronze = build_all(stored)
    text = plan(states.dispatch_context(bronze["bronze_operational_signals"]))
    assert columns_read(text) == [
        {"source_system", "route_id", "market_key", "terminal_id", "freight_cost",
         "telematics_risk", "retail_location_id"}
    ]
    assert "PushedFilters: [IsNotNull(source_system)]" in text


def test_registered_question_is_lazy_and_filters_the_tables(spark, data):
    text = plan(QUERIES["ask_planner_reason"](spark, data))
    assert "lineitem" in text and "depotlens-" not in text
    product = re.findall(r"Condition *: .*PRD-02", text)
    assert len(product) >= 2
    assert all(text.index(p) > text.index("Join") for p in product)


@pytest.mark.parametrize("name", ["decision_summary", "decisions", "gold_row_counts", "planner_explainability"])
def test_registered_queries_start_no_job(spark, data, name):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"planning {name}", "")
    QUERIES[name](spark, data)
    assert not tracker.getJobIdsForGroup(f"planning {name}")


def test_question_filter_reaches_the_scan(stored):
    planner = build_all(stored)[GOLD[1]]
    text = plan(reports.planner_reason(planner, "MKT-03", "PRD-02"))
    pushed = re.findall(r"PushedFilters: \[(.*)\]", text)
    assert len(pushed) == 2
    assert all("EqualTo(market_key,MKT-03)" in p and "EqualTo(product_id,PRD-02)" in p for p in pushed)


@pytest.mark.parametrize(
    "name", ["report_inventory_health", "report_forecast_trend", "report_dispatch_risk", "top_forecasts"]
)
def test_reports_keep_only_the_top_rows(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    assert "TakeOrderedAndProject" in text
    assert "Sort [" not in text.split("TakeOrderedAndProject")[0]


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("stream", "reconcile", "material"))])
def test_no_cross_join_and_no_python(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "Python", "ArrowEval"):
        assert unwanted not in text


def test_aggregates_are_partial_first(stored):
    for state in states.STATES.values():
        text = plan(state.from_signals(stored))
        assert "partial_max" in text or "partial_avg" in text
