"""Hand-made input rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from depotlens.schema import SIGNALS

BASE = {
    "id": 1,
    "source_system": "gurobi",
    "signal_timestamp": datetime(2024, 5, 1),
    "market_key": "M1",
    "terminal_id": "T1",
    "product_id": "P1",
    "route_id": "R1",
    "retail_location_id": "L1",
    "inventory_units": 600.0,
    "demand_units": 150.0,
    "wholesale_cost": 160.0,
    "retail_price": 3.0,
    "weather_index": 0.25,
    "freight_cost": 50.0,
    "telematics_risk": 0.25,
    "planner_override_flag": False,
    "source_record_id": "r",
    "ingest_batch_id": "b",
    "quality_flag": "ok",
    "record_created_ts": datetime(2024, 5, 1),
}


def signals(spark: SparkSession, *changes: dict) -> DataFrame:
    rows = [tuple({**BASE, **change}[c] for c in SIGNALS.names) for change in changes]
    return spark.createDataFrame(rows, SIGNALS)


def frame(spark: SparkSession, schema: str, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def column(result: DataFrame, name: str, order: str = "n") -> list:
    return [row[name] for row in result.orderBy(order).collect()]


def as_set(result: DataFrame) -> list[str]:
    return sorted(str(tuple(row)) for row in result.collect())
