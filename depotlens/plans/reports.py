"""Ranked reports, counts and the question pack, over finished tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.schema import LANE, OFFER, POSITION

REPORT_ROWS = 200
SHORT_ROWS = 20


def _top(frame: DataFrame, measure: str, key: tuple[str, ...], rows: int) -> DataFrame:
    """First rows by ``measure``; the key decides ties, so the cut is the same every time."""
    return frame.orderBy(F.desc_nulls_last(measure), *key).limit(rows)


def _exact_sum(column: str, digits: int) -> Column:
    """Sum of values rounded to ``digits``, in decimals, so that the order in which tasks
    finish cannot change it. Values need fewer than 22 digits before the point."""
    return F.sum(F.col(column).cast(f"decimal(28,{digits})")).cast("double")


def inventory_health(visibility: DataFrame, rows: int = REPORT_ROWS) -> DataFrame:
    return _top(visibility, "inventory_utilization_ratio", POSITION, rows).select(
        *POSITION,
        "inventory_health",
        "inventory_units_avg",
        "demand_units_avg",
        "inventory_utilization_ratio",
    )


def forecast_trend(forecast: DataFrame, rows: int = REPORT_ROWS) -> DataFrame:
    return _top(forecast, "ai_forecast_units", OFFER, rows).select(
        *OFFER,
        "ai_forecast_units",
        "forecast_confidence",
        "forecast_lower_bound",
        "forecast_upper_bound",
    )


def dispatch_risk(exposure: DataFrame, rows: int = REPORT_ROWS) -> DataFrame:
    return _top(exposure, "route_cost_exposure", LANE, rows).select(
        "market_key",
        "route_id",
        "dispatch_risk_level",
        "route_cost_exposure",
        "freight_cost_avg",
        "telematics_risk_avg",
    )


def top_forecasts(forecast: DataFrame, rows: int = SHORT_ROWS) -> DataFrame:
    return _top(forecast, "ai_forecast_units", OFFER, rows).select(
        *OFFER, "ai_forecast_units", "forecast_confidence"
    )


def decision_summary(decided: DataFrame) -> DataFrame:
    """Rows per action and reason of a finished decision table, most frequent first."""
    counted = decided.groupBy("ai_query_action", "ai_query_reason_code").agg(
        F.count("*").alias("decision_count")
    )
    return ranked_summary(counted)


def ranked_summary(counted: DataFrame) -> DataFrame:
    return counted.orderBy(F.desc("decision_count"), "ai_query_action", "ai_query_reason_code")


def signals_by_source(signals: DataFrame) -> DataFrame:
    return (
        signals.groupBy("source_system")
        .agg(F.count("*").alias("row_count"))
        .orderBy(F.asc_nulls_first("source_system"))
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    def counted(name: str, frame: DataFrame) -> DataFrame:
        total = frame.agg(F.count("*").alias("row_count"))
        return total.select(F.lit(name).alias("table_name"), "row_count")

    return reduce(DataFrame.unionAll, [counted(n, frame) for n, frame in tables.items()])


def inventory_by_terminal(visibility: DataFrame) -> DataFrame:
    """How much inventory is there right now, by market and terminal?"""
    return visibility.groupBy("market_key", "terminal_id").agg(
        _exact_sum("inventory_units_avg", 6).alias("inventory_units"),
        F.max("as_of_ts").alias("as_of_ts"),
        F.count_if(F.col("inventory_health") == "at_risk").alias("at_risk_products"),
    )


def planner_reason(
    planner: DataFrame, market: str | None = None, product: str | None = None
) -> DataFrame:
    """Why was a planner decision made, for one market and product or for all?"""
    wanted: list[Column] = []
    if market is not None:
        wanted.append(F.col("market_key") == market)
    if product is not None:
        wanted.append(F.col("product_id") == product)
    return reduce(DataFrame.where, wanted, planner).select(
        *OFFER,
        "terminal_id",
        "inventory_pressure_score",
        "weather_pressure_score",
        "price_spread",
        "planner_override_count",
        "planner_reason_code",
    )


def top_markets(forecast: DataFrame) -> DataFrame:
    """Which markets have the highest forecast demand over the horizon?"""
    return (
        forecast.groupBy("market_key")
        .agg(_exact_sum("ai_forecast_units", 2).alias("forecast_units"))
        .orderBy(F.desc_nulls_last("forecast_units"), "market_key")
    )


def route_risk(exposure: DataFrame) -> DataFrame:
    """Which routes carry the highest exposure?"""
    return (
        exposure.groupBy("route_id")
        .agg(
            F.max("route_cost_exposure").alias("route_cost_exposure_peak"),
            F.count_if(F.col("dispatch_risk_level") == "high").alias("high_risk_lanes"),
        )
        .orderBy(F.desc_nulls_last("route_cost_exposure_peak"), "route_id")
    )
