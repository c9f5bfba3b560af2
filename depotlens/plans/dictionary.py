"""The data dictionary: what every table and column means."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from depotlens.functions.scalars import sql_quoted
from depotlens.schema import BRONZE, GOLD, SILVER
from depotlens.sources.store import CatalogStore

DICTIONARY_SCHEMA = (
    "table_name string, position int, column_name string, data_type string, comment string"
)

TABLE_TEXT = {
    "bronze_operational_signals": "Accepted signals as landed, one row per event.",
    "silver_inventory_state": "Stock, demand and prices averaged per market, terminal and product.",
    "silver_demand_drivers": "What drives demand per market and product: weather, prices, overrides.",
    "silver_dispatch_context": "Freight cost, road risk and stores served per route, market, terminal.",
    "gold_inventory_visibility": "Inventory state with its health class and share of stock demanded.",
    "gold_planner_explainability": "Scores behind each inventory position and the leading reason.",
    "gold_demand_forecast": "Demand forecast per market and product with confidence and bounds.",
    "gold_dispatch_exposure": "Dispatch lanes with their risk class.",
    "gold_sales_context": "Forecast, price spread and sales band per market and product.",
    "gold_ai_query_decisions": "Recommended action and reason per position and lane of its market.",
}

# A column means the same in every table that carries it, unless listed below.
COLUMN_TEXT = {
    "id": "Number of the event within its source.",
    "source_system": "System that sent the signal.",
    "signal_timestamp": "When the signal was observed.",
    "market_key": "Market the row belongs to.",
    "terminal_id": "Terminal that stores or supplies the product.",
    "product_id": "Fuel product.",
    "route_id": "Delivery route.",
    "retail_location_id": "Store that is supplied.",
    "inventory_units": "Units in stock.",
    "demand_units": "Units asked for.",
    "wholesale_cost": "Purchase cost in cents.",
    "retail_price": "Selling price in whole currency units.",
    "weather_index": "Weather pressure between 0 and 1.",
    "freight_cost": "Cost of moving the load; may be missing.",
    "telematics_risk": "Vehicle and road risk between 0 and 1.",
    "planner_override_flag": "True if a planner overruled the system.",
    "source_record_id": "Record identifier of the batch and event.",
    "ingest_batch_id": "Batch the event landed with.",
    "quality_flag": "Quality mark of the source, ok or warning.",
    "record_created_ts": "When the record was written.",
    "as_of_ts": "Latest signal that went into the row.",
    "inventory_units_avg": "Mean units in stock.",
    "inventory_units_peak": "Most units seen in stock.",
    "warning_signal_count": "Signals marked with a warning.",
    "demand_units_avg": "Mean units asked for.",
    "retail_price_avg": "Mean selling price.",
    "wholesale_cost_avg": "Mean purchase cost in cents.",
    "weather_index_avg": "Mean weather pressure.",
    "inventory_gap_units": "Peak stock less mean stock.",
    "baseline_demand_units": "Mean demand of the market and product before any lift.",
    "planner_override_count": "Signals on which a planner overruled the system.",
    "price_spread": "Mean price less mean cost, both in currency units, to three digits.",
    "freight_cost_avg": "Mean freight cost.",
    "freight_cost_peak": "Highest freight cost.",
    "telematics_risk_avg": "Mean vehicle and road risk.",
    "served_location_count": "Different stores served.",
    "route_cost_exposure": "Highest freight cost times stores served.",
    "inventory_health": "at_risk, watch or healthy by mean stock.",
    "inventory_utilization_ratio": "Mean demand over mean stock; NULL for no stock.",
    "inventory_pressure_score": "Stock gap over mean stock, to four digits; NULL for no stock.",
    "weather_pressure_score": "Mean weather pressure to four digits.",
    "planner_reason_code": "Leading reason: stock variability, weather, or stable.",
    "ai_forecast_units": "Forecast demand in units.",
    "forecast_confidence": "Confidence, lowered by every override; not bounded below.",
    "forecast_lower_bound": "Lower end of the forecast range.",
    "forecast_upper_bound": "Upper end of the forecast range.",
    "forecast_horizon_days": "Days the forecast covers.",
    "dispatch_risk_level": "high, medium or low by exposure or road risk.",
    "sales_priority_band": "Sales band by forecast demand.",
    "inventory_risk_flag": "True if stock pressure is above its limit.",
    "demand_surge_flag": "True if forecast demand is above its limit.",
    "freight_risk_flag": "True if exposure is above the limit for rerouting.",
    "ai_query_action": "Recommended action.",
    "ai_query_reason_code": "Rule that led to the action.",
    "decision_timestamp": "When the decision was computed.",
}

COLUMN_TEXT_IN = {
    ("gold_planner_explainability", "weather_index_avg"): (
        "Mean weather pressure of the market and product."
    ),
    ("gold_ai_query_decisions", "weather_index_avg"): (
        "Mean weather pressure of the market and product."
    ),
    ("gold_ai_query_decisions", "terminal_id"): "Terminal of the inventory position.",
    ("gold_ai_query_decisions", "route_cost_exposure"): "Exposure of the lane, 0 if there is none.",
    ("gold_ai_query_decisions", "dispatch_risk_level"): "Risk of the lane, low if there is none.",
}


def column_text(table: str, column: str) -> str | None:
    return COLUMN_TEXT_IN.get((table, column), COLUMN_TEXT.get(column))


def data_dictionary(spark: SparkSession, schemas: Mapping[str, StructType]) -> DataFrame:
    """One row per column of the given tables."""
    rows = [
        (table, position, c.name, c.dataType.simpleString(), column_text(table, c.name))
        for table, schema in schemas.items()
        for position, c in enumerate(schema, start=1)
    ]
    return spark.createDataFrame(rows, DICTIONARY_SCHEMA)


def gaps(dictionary: DataFrame, actual: DataFrame) -> DataFrame:
    """Columns without a description, and described columns that do not exist.

    ``actual`` has the dictionary's columns; no row means the dictionary is complete."""
    place = ["table_name", "column_name"]
    described = dictionary.where(F.trim("comment") != "").select(place)
    missing = actual.select(place).join(described, place, "left_anti")
    surplus = described.join(actual.select(place), place, "left_anti")
    return missing.withColumn("gap", F.lit("not described")).unionAll(
        surplus.withColumn("gap", F.lit("no such column"))
    )


def with_comments(table: str, frame: DataFrame) -> DataFrame:
    """The frame with its descriptions in the schema, as a table write stores them."""
    columns = {c.name: column_text(table, c.name) for c in frame.schema}
    for name, text in columns.items():
        if text is not None:
            metadata = {**frame.schema[name].metadata, "comment": text}
            frame = frame.withMetadata(name, metadata)
    return frame


def comment_statements(full_name: str, table: str, schema: StructType) -> list[str]:
    statements = [f"COMMENT ON TABLE {full_name} IS {sql_quoted(TABLE_TEXT[table])}"]
    for column in schema.names:
        text = column_text(table, column)
        if text is not None:
            change = f"ALTER COLUMN `{column}` COMMENT {sql_quoted(text)}"
            statements.append(f"ALTER TABLE {full_name} {change}")
    return statements


def apply_comments(store: CatalogStore, tables: tuple[str, ...] = SILVER + GOLD) -> int:
    """Describe the catalog tables; the number of statements run. Bronze is only
    listed in the dictionary, since a table that a stream fills is left alone."""
    applied = 0
    for table in tables:
        if table in BRONZE:
            continue
        schema = store.read(table).schema
        for statement in comment_statements(store.full_name(table), table, schema):
            store.spark.sql(statement)
            applied += 1
    return applied
