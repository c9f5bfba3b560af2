"""The six rule and score (gold) tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.functions.rules import DEFAULT, Limits
from depotlens.functions.scalars import first_match
from depotlens.operators.fanout import PAIRS_PER_BLOCK, block_tasks, fan_out_join
from depotlens.operators.measures import State
from depotlens.operators.spread import dealt
from depotlens.schema import OFFER



@dataclass(frozen=True)
class Rule:
    """A case of the decision table. Its flags belong to the planner row or to the lane."""

    flags: tuple[str, ...]
    action: str
    reason: str


# The cases in order, the first whose flags are all true decides.
RULES = (
    Rule(("inventory_risk_flag", "demand_surge_flag"), "increase_terminal_replenishment", "inventory_gap_with_demand_surge"),
    Rule(("freight_risk_flag",), "reroute_dispatch", "route_cost_threshold"),
    Rule(("high_risk",), "escalate_dispatch_review", "telematics_and_dispatch_risk"),
)
OTHERWISE = Rule((), "maintain_current_plan", "criteria_within_tolerance")
POSITION_FLAGS = ("inventory_risk_flag", "demand_surge_flag")


def inventory_visibility(inventory: DataFrame, limits: Limits = DEFAULT) -> DataFrame:
    units = F.col("inventory_units_avg")
    return inventory.withColumns(
        {
            "inventory_health": first_match(
                (units < limits.at_risk_below, "at_risk"),
                (units < limits.watch_below, "watch"),
                otherwise="healthy",
            ),
            "inventory_utilization_ratio": F.round(
                F.try_divide(F.col("demand_units_avg"), units), 4
            ),
        }
    )


def planner_explainability(
    inventory: DataFrame, demand: DataFrame, limits: Limits = DEFAULT
) -> DataFrame:
    """Inventory positions with the demand picture of their market and product.
    Prices are those of the position, weather is that of the demand side."""
    drivers = demand.select(
        *OFFER, "baseline_demand_units", "weather_index_avg", "price_spread", "planner_override_count"
    )
    return _explained(inventory.drop("weather_index_avg").join(drivers, list(OFFER), "inner"), limits)


def positions_from_rollup(
    rolled: DataFrame, inventory: State, demand: State, limits: Limits = DEFAULT, tasks: int = 0
) -> DataFrame:
    """Planner rows with their forecast, as :func:`planner_explainability` and
    :func:`forecast_positions` give them, from one rollup to the positions. The demand
    picture of an offer is a window over its positions, so the signals are read once and
    nothing is joined. Where positions grow with the data, their offers are dealt to ``tasks``
    tasks; an offer is one task's."""
    known = dealt(rolled.where(" AND ".join(f"{key} IS NOT NULL" for key in OFFER)), tasks, *OFFER)
    drivers = known.withColumns(demand.beside()).withColumns({n: build() for n, build in demand.derived.items()})
    shared = ("baseline_demand_units", "weather_index_avg", "price_spread", "planner_override_count")
    values = {n: c for n, c in inventory.of_row().items() if n not in shared}
    joined = drivers.select(*inventory.keys, *shared, *(c.alias(n) for n, c in values.items()))
    planner = _explained(joined.withColumns({n: build() for n, build in inventory.derived.items()}), limits)
    # the forecast needs nothing but the demand picture that the planner row carries
    return demand_forecast(planner, limits).select(*planner.columns, "ai_forecast_units", "forecast_confidence")


def _explained(joined: DataFrame, limits: Limits) -> DataFrame:
    gap_share = F.try_divide(F.col("inventory_gap_units"), F.col("inventory_units_avg"))
    scored = joined.select(
        *OFFER,
        "terminal_id",
        "as_of_ts",
        "inventory_units_avg",
        "inventory_units_peak",
        "warning_signal_count",
        "demand_units_avg",
        "retail_price_avg",
        "wholesale_cost_avg",
        "inventory_gap_units",
        "baseline_demand_units",
        "weather_index_avg",
        "price_spread",
        "planner_override_count",
        F.round(gap_share, 4).alias("inventory_pressure_score"),
        F.round("weather_index_avg", 4).alias("weather_pressure_score"),
    )
    reason = first_match(
        (F.col("inventory_pressure_score") > limits.pressure_above, "inventory_variability"),
        (F.col("weather_pressure_score") > limits.weather_above, "weather_shift"),
        otherwise="stable_signal",
    )
    return scored.withColumn("planner_reason_code", reason)


def demand_forecast(demand: DataFrame, limits: Limits = DEFAULT) -> DataFrame:
    """Closed-form forecast. The bounds start from the rounded forecast."""
    weather = F.lit(1.0) + F.col("weather_index_avg") * F.lit(limits.weather_lift)
    price = F.lit(1.0) + F.col("price_spread") * F.lit(limits.spread_lift)
    penalty = F.col("planner_override_count") * F.lit(limits.override_penalty)
    forecast = F.col("ai_forecast_units")
    return demand.withColumns(
        {
            "ai_forecast_units": F.round(F.col("baseline_demand_units") * weather * price, 2),
            "forecast_confidence": F.round(F.lit(limits.base_confidence) - penalty, 3),
        }
    ).withColumns(
        {
            "forecast_lower_bound": F.round(forecast * F.lit(limits.lower_share), 2),
            "forecast_upper_bound": F.round(forecast * F.lit(limits.upper_share), 2),
            "forecast_horizon_days": F.lit(limits.horizon_days),
        }
    )


def dispatch_exposure(dispatch: DataFrame, limits: Limits = DEFAULT) -> DataFrame:
    def either(exposure: float, telematics: float) -> Column:
        over_cost = F.col("route_cost_exposure") > exposure
        return over_cost | (F.col("telematics_risk_avg") > telematics)

    level = first_match(
        (either(limits.high_exposure_above, limits.high_telematics_above), "high"),
        (either(limits.medium_exposure_above, limits.medium_telematics_above), "medium"),
        otherwise="low",
    )
    return dispatch.withColumn("dispatch_risk_level", level)


def sales_context(forecast: DataFrame, limits: Limits = DEFAULT) -> DataFrame:
    units = F.col("ai_forecast_units")
    return forecast.select(
        *OFFER,
        "ai_forecast_units",
        "forecast_confidence",
        "forecast_horizon_days",
        "price_spread",
        "weather_index_avg",
        first_match(
            (units > limits.growth_above, "growth_opportunity"),
            (units > limits.steady_above, "steady_state"),
            otherwise="demand_watch",
        ).alias("sales_priority_band"),
    )


def decisions(
    planner: DataFrame,
    forecast: DataFrame,
    dispatch: DataFrame,
    limits: Limits = DEFAULT,
    as_of: Column | None = None,
    pairs_per_block: int = PAIRS_PER_BLOCK,
    tasks: int | None = None,
) -> DataFrame:
    """One row per planner row and dispatch lane of its market, with the action to take.
    ``tasks`` is passed to the join, see :func:`decision_tasks`."""
    return decided(forecast_positions(planner, forecast), dispatch, limits, as_of, pairs_per_block, tasks)


def decided(
    positions: DataFrame,
    dispatch: DataFrame,
    limits: Limits = DEFAULT,
    as_of: Column | None = None,
    pairs_per_block: int = PAIRS_PER_BLOCK,
    tasks: int | None = None,
) -> DataFrame:
    """:func:`decisions` of planner rows that have their forecast."""
    paired = fan_out_join(
        positions,
        dispatch,
        key="market_key",
        left_id=("terminal_id", "product_id"),
        right_id=("route_id", "terminal_id"),
        carry=("route_cost_exposure", "dispatch_risk_level"),
        how="left",
        pairs_per_block=pairs_per_block,
        tasks=tasks,
    )
    flags = _flags(limits)
    flagged = paired.withColumns(_lane_defaults()).withColumns(flags)
    clock = F.current_timestamp() if as_of is None else as_of
    return flagged.withColumns({**_outcome(), "decision_timestamp": clock}).drop("high_risk")


def decision_tasks(planner: DataFrame, dispatch: DataFrame) -> int:
    """Tasks for :func:`decisions` over stored tables. Every planner row has one forecast
    row, so planner rows are the positions."""
    return block_tasks(planner, dispatch, "market_key")


def decision_counts(
    planner: DataFrame,
    forecast: DataFrame,
    dispatch: DataFrame,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Rows of :func:`decisions` per action and reason, without building them.

    A decision depends on flags of the planner row and flags of the lane only. So each
    side shrinks to one row per market and combination of its flags before they meet,
    and the number of pairs is the product of the two counts."""
    return decided_counts(forecast_positions(planner, forecast), dispatch, limits)


def decided_counts(positions: DataFrame, dispatch: DataFrame, limits: Limits = DEFAULT) -> DataFrame:
    """:func:`decision_counts` of planner rows that have their forecast."""
    flags = _flags(limits)
    of_position = [flags[name].alias(name) for name in POSITION_FLAGS]
    of_lane = [flag.alias(name) for name, flag in flags.items() if name not in POSITION_FLAGS]
    positions = (
        positions
        .groupBy("market_key", *of_position)
        .agg(F.count("*").alias("positions"))
    )
    lanes = (
        dispatch.select("market_key", "route_cost_exposure", "dispatch_risk_level")
        .withColumns(_lane_defaults())
        .groupBy("market_key", *of_lane)
        .agg(F.count("*").alias("lanes"))
    )
    pairs = F.col("positions") * F.coalesce(F.col("lanes"), F.lit(1))
    labels = [label.alias(name) for name, label in _outcome().items()]
    return (
        positions.join(lanes, "market_key", "left")
        .groupBy(*labels)
        .agg(F.sum(pairs).alias("decision_count"))
    )


def forecast_positions(planner: DataFrame, forecast: DataFrame) -> DataFrame:
    """Planner rows with the forecast of their market and product."""
    outlook = forecast.select(*OFFER, "ai_forecast_units", "forecast_confidence")
    return planner.join(outlook, list(OFFER), "inner")


def _lane_defaults() -> dict[str, Column]:
    return {
        "route_cost_exposure": F.coalesce(F.col("route_cost_exposure"), F.lit(0.0)),
        "dispatch_risk_level": F.coalesce(F.col("dispatch_risk_level"), F.lit("low")),
    }


def _flags(limits: Limits) -> dict[str, Column]:
    return {
        "inventory_risk_flag": F.col("inventory_pressure_score") > limits.pressure_above,
        "demand_surge_flag": F.col("ai_forecast_units") > limits.growth_above,
        "freight_risk_flag": F.col("route_cost_exposure") > limits.freight_above,
        "high_risk": F.col("dispatch_risk_level") == "high",
    }


def _outcome() -> dict[str, Column]:
    """Action and reason over the flags; a flag that is NULL is not true."""

    def label(of: Callable[[Rule], str]) -> Column:
        arms = [(reduce(Column.__and__, map(F.col, rule.flags)), of(rule)) for rule in RULES]
        return first_match(*arms, otherwise=of(OTHERWISE))

    return {
        "ai_query_action": label(lambda rule: rule.action),
        "ai_query_reason_code": label(lambda rule: rule.reason),
    }
