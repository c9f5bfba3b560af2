"""The decision table: joins, fan-out, fills, order of rules and counting."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from rows import as_set, frame

from depotlens.operators import serving
from depotlens.operators.fanout import fan_out_join
from depotlens.plans import reports
from depotlens.plans.graph import build_all
from depotlens.schema import GOLD
from depotlens.sources.signals import signals_from

PLANNER = "market_key string, product_id string, terminal_id string, inventory_pressure_score double"
FORECAST = "market_key string, product_id string, ai_forecast_units double, forecast_confidence double"
LANES = (
    "route_id string, market_key string, terminal_id string,"
    "route_cost_exposure double, dispatch_risk_level string"
)
AS_OF = datetime(2024, 1, 1)


def decide(spark, planner, forecast, lanes, **options):
    inputs = (
        frame(spark, PLANNER, *planner),
        frame(spark, FORECAST, *forecast),
        frame(spark, LANES, *lanes),
    )
    return serving.decisions(*inputs, as_of=F.lit(AS_OF), **options), inputs


def single(spark, pressure, units, exposure, level):
    found, _ = decide(
        spark,
        [("M", "P", "T", pressure)],
        [("M", "P", units, 0.8)],
        [("R", "M", "X", exposure, level)],
    )
    return found.first()


@pytest.mark.parametrize(
    ("pressure", "units", "exposure", "level", "action"),
    [
        (0.3, 300.0, 2000.0, "high", "increase_terminal_replenishment"),
        (0.2, 300.0, 2000.0, "high", "reroute_dispatch"),
        (0.3, 220.0, 1100.1, "medium", "reroute_dispatch"),
        (0.3, 220.0, 1100.0, "medium", "maintain_current_plan"),
        (0.1, 100.0, 0.0, "high", "escalate_dispatch_review"),
        (0.1, 100.0, None, None, "maintain_current_plan"),
        (None, 300.0, 0.0, "low", "maintain_current_plan"),
        (0.3, None, 0.0, "high", "escalate_dispatch_review"),
    ],
)
def test_first_matching_rule_wins(spark, pressure, units, exposure, level, action):
    row = single(spark, pressure, units, exposure, level)
    assert row.ai_query_action == action
    reasons = {rule.action: rule.reason for rule in (*serving.RULES, serving.OTHERWISE)}
    assert row.ai_query_reason_code == reasons[action]


def test_flags_keep_null_but_freight_is_filled(spark):
    row = single(spark, None, None, None, None)
    assert row.inventory_risk_flag is None and row.demand_surge_flag is None
    assert row.freight_risk_flag is False
    assert (row.route_cost_exposure, row.dispatch_risk_level) == (0.0, "low")
    assert row.decision_timestamp == AS_OF


def test_market_without_lane_is_kept(spark):
    found, _ = decide(
        spark, [("M", "P", "T", 0.1)], [("M", "P", 100.0, 0.8)], [("R", "other", "X", 9.0, "high")]
    )
    row = found.first()
    assert found.count() == 1
    assert (row.route_cost_exposure, row.dispatch_risk_level) == (0.0, "low")
    assert row.ai_query_action == "maintain_current_plan"


def test_each_position_meets_each_lane_of_its_market(spark):
    found, _ = decide(
        spark,
        [("M", "P", "T1", 0.1), ("M", "P", "T2", 0.1)],
        [("M", "P", 100.0, 0.8)],
        [(f"R{n}", "M", "X", float(n), "low") for n in range(3)],
    )
    assert found.count() == 6
    assert {r.terminal_id for r in found.collect()} == {"T1", "T2"}


def test_null_keys_do_not_join(spark):
    found, _ = decide(
        spark, [(None, "P", "T", 0.1)], [(None, "P", 1.0, 0.8)], [("R", None, "X", 1.0, "low")]
    )
    assert found.count() == 0


def random_tables(seed):
    """Few markets, one of them holding most rows; NULLs and unmatched sides."""
    rng = random.Random(seed)
    markets = ["hot"] * 6 + ["a", "b", "c", None]
    products = ["p", "q", "r"]
    planner = {
        (rng.choice(markets), rng.choice(products), f"t{n % 40}"): rng.choice([None, 0.1, 0.3])
        for n in range(160)
    }
    planner[("lonely", "p", "t")] = 0.3
    forecast = [
        (m, p, rng.choice([None, 100.0, 300.0]), 0.5)
        for m in ("hot", "a", "b", "c", "lonely")
        for p in products
        if rng.random() < 0.9 or m in ("lonely", "hot")
    ]
    lanes = [
        (f"r{n}", rng.choice(markets), "x", rng.choice([None, 500.0, 1200.0]), rng.choice(["low", "medium", "high"]))
        for n in range(60)
    ]
    return [(*k, v) for k, v in planner.items()], forecast, lanes


def brute_force(planner, forecast, lanes):
    """Pairs by nested loops."""
    pairs = []
    for market, product, terminal, pressure in planner:
        for f_market, f_product, units, _ in forecast:
            if market is None or (market, product) != (f_market, f_product):
                continue
            matches = [lane for lane in lanes if lane[1] == market] or [(None,) * 5]
            for *_, exposure, level in matches:
                exposure, level = exposure or 0.0, level or "low"
                if (pressure or 0) > 0.2 and (units or 0) > 220:
                    action = "increase_terminal_replenishment"
                elif exposure > 1100:
                    action = "reroute_dispatch"
                else:
                    action = "escalate_dispatch_review" if level == "high" else "maintain_current_plan"
                pairs.append(str((market, product, terminal, exposure, level, action)))
    return sorted(pairs)


SHOWN = (
    "market_key", "product_id", "terminal_id",
    "route_cost_exposure", "dispatch_risk_level", "ai_query_action",
)


@pytest.mark.parametrize("block", [1, 7, 50, 10**9])
def test_decisions_match_brute_force_however_they_are_cut(spark, block):
    tables = random_tables(block)
    found, _ = decide(spark, *tables, pairs_per_block=block)
    assert as_set(found.select(*SHOWN)) == brute_force(*tables)


def test_counts_without_pairs_match_the_table(spark):
    for seed in (3, 4):
        found, inputs = decide(spark, *random_tables(seed))
        counted = serving.decision_counts(*inputs)
        assert as_set(counted) == as_set(reports.decision_summary(found))


def test_fan_out_join_rejects_other_kinds(spark):
    one = frame(spark, "k string, v int", ("a", 1))
    with pytest.raises(ValueError, match="full"):
        fan_out_join(one, one, "k", ["v"], ["v"], [], how="full")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_fan_out_join_equals_plain_join(spark, how):
    left = spark.range(200).select((F.col("id") % 3).alias("k"), F.col("id").alias("a"))
    right = spark.range(90).select((F.col("id") % 2).alias("k"), F.col("id").alias("b"))
    cut = fan_out_join(left, right, "k", ["a"], ["b"], ["b"], how, pairs_per_block=100)
    assert as_set(cut) == as_set(left.join(right, "k", how))


def test_decision_rows_are_the_sum_of_products(spark, data):
    tables = build_all(signals_from(spark, data))
    planner, exposure, decided = (tables[GOLD[i]] for i in (1, 3, 5))
    lanes = {r.market_key: r["count"] for r in exposure.groupBy("market_key").count().collect()}
    positions = planner.groupBy("market_key").count().collect()
    assert decided.count() == sum(r["count"] * lanes[r.market_key] for r in positions)
    assert len(decided.columns) == 28


def test_forecast_lies_between_its_bounds(spark, data):
    forecast = build_all(signals_from(spark, data))[GOLD[2]]
    inside = "forecast_lower_bound <= ai_forecast_units AND ai_forecast_units <= forecast_upper_bound"
    assert forecast.where(f"NOT ({inside})").count() == 0


def test_visibility_has_one_row_per_position(spark, data):
    tables = build_all(signals_from(spark, data))
    assert tables[GOLD[0]].count() == tables["silver_inventory_state"].count()
