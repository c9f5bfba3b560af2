"""The three states: aggregates, rollup and properties."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from rows import as_set, signals

from depotlens.operators import states
from depotlens.operators.measures import families, rollup
from depotlens.operators.quality import expect_or_drop, expectation_counts
from depotlens.plans.graph import planned_states
from depotlens.sources.signals import signals_from
from depotlens.sources.store import FolderStore

NOTHING = {
    "inventory_units": None, "demand_units": None, "wholesale_cost": None, "retail_price": None,
    "weather_index": None, "freight_cost": None, "telematics_risk": None,
    "planner_override_flag": None, "quality_flag": None, "signal_timestamp": None,
}


def test_inventory_state(spark):
    row = states.inventory_state(
        signals(
            spark,
            {"inventory_units": 100.0, "quality_flag": "warning"},
            {"inventory_units": 300.0, "signal_timestamp": datetime(2024, 6, 1)},
            {"inventory_units": None, "quality_flag": None},
        )
    ).first()
    assert row.as_of_ts == datetime(2024, 6, 1)
    assert (row.inventory_units_avg, row.inventory_units_peak) == (200.0, 300.0)
    assert (row.inventory_gap_units, row.warning_signal_count) == (100.0, 1)


def test_demand_drivers(spark):
    changes = [{"retail_price": 3.2, "wholesale_cost": 172.0, "planner_override_flag": f} for f in (True, False, None)]
    row = states.demand_drivers(signals(spark, *changes)).first()
    assert row.price_spread == 1.48
    assert row.planner_override_count == 1


def test_dispatch_context_counts_known_locations_once(spark):
    changes = [{"retail_location_id": v, "freight_cost": 30.0} for v in ("A", "A", "B", None)]
    row = states.dispatch_context(signals(spark, *changes)).first()
    assert row.served_location_count == 2
    assert row.route_cost_exposure == 60.0


def test_null_keys_form_a_group(spark):
    found = states.inventory_state(signals(spark, {"market_key": None}, {"market_key": None}, {}))
    assert found.count() == 2


@pytest.mark.parametrize("name", states.STATES)
def test_rollup_gives_the_same_state(spark, data, name):
    signals_frame = signals_from(spark, data)
    state = states.STATES[name]
    rolled = rollup(signals_frame, states.STATES.values())
    direct, merged = state.from_signals(signals_frame), state.from_rollup(rolled)
    assert direct.schema.simpleString() == merged.schema.simpleString()
    assert as_set(direct) == as_set(merged)


@pytest.mark.parametrize("name", states.STATES)
def test_rollup_keeps_nulls(spark, name):
    frame = signals(
        spark,
        NOTHING,
        {"retail_location_id": None},
        {"market_key": None, "terminal_id": None},
        {"route_id": None, **NOTHING},
    )
    rolled = rollup(frame, states.STATES.values())
    state = states.STATES[name]
    assert as_set(state.from_signals(frame)) == as_set(state.from_rollup(rolled))


def test_rollups_of_two_batches_merge(spark, data):
    frame = signals_from(spark, data)
    early = F.col("id") % 3 == 0
    parts = [rollup(frame.where(c), states.STATES.values()) for c in (early, ~early)]
    for state in states.STATES.values():
        merged = state.from_rollup(parts[0].unionByName(parts[1]))
        assert as_set(merged) == as_set(state.from_signals(frame))


def test_input_order_does_not_matter(spark, data):
    frame = signals_from(spark, data)
    shuffled = frame.repartition(7, F.hash("source_record_id"))
    for state in states.STATES.values():
        assert as_set(state.from_signals(frame)) == as_set(state.from_signals(shuffled))


def test_gap_is_never_negative(spark, data):
    found = states.inventory_state(signals_from(spark, data))
    assert found.where("inventory_gap_units < 0").count() == 0


def test_families_nest(spark):
    names = [list(family) for family in families(states.STATES)]
    assert names == [["silver_dispatch_context"], ["silver_inventory_state", "silver_demand_drivers"]]


def test_planned_states_equal_direct_ones(spark, data, tmp_path):
    frame = signals_from(spark, data)
    plans = planned_states(frame, FolderStore(spark, str(tmp_path)))
    for name, state in states.STATES.items():
        direct = state.from_signals(frame)
        assert plans[name].dtypes == direct.dtypes
        assert as_set(plans[name]) == as_set(direct)


def test_one_hot_group_is_whole(spark):
    """A third of all rows in one group: still counted in full."""
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("M"), F.col("id") % 500)).alias("market_key"), F.col("id"))
    base = signals(spark, {}).drop("market_key", "id", "retail_location_id")
    frame = hot.crossJoin(base).withColumn("retail_location_id", (F.col("id") % 900).cast("string"))
    direct = states.dispatch_context(frame)
    merged = states.DISPATCH.from_rollup(rollup(frame, states.STATES.values()))
    row = direct.where("market_key = 'hot'").first()
    assert row.served_location_count == 300
    assert as_set(direct) == as_set(merged)


def test_expectation_drops_and_counts(spark):
    frame = signals(spark, {}, {"source_system": None}, {"source_system": "x"})
    seen = Observation("quality")
    kept = expect_or_drop(frame, observation=seen)
    assert kept.count() == 2
    assert seen.get == {"valid_source_system_passed": 2, "valid_source_system_failed": 1}
    assert [tuple(r) for r in expectation_counts(frame).collect()] == [("valid_source_system", 2, 1)]


def test_unknown_expectation_outcome_is_a_failure(spark):
    frame = signals(spark, {"inventory_units": None}, {"inventory_units": 5.0}, {"inventory_units": -1.0})
    rules = {"stock": "inventory_units >= 0", "named": "source_system IS NOT NULL"}
    assert expect_or_drop(frame, rules).count() == 1
    found = {r.expectation: (r.passed, r.failed) for r in expectation_counts(frame, rules).collect()}
    assert found == {"stock": (1, 2), "named": (3, 0)}
