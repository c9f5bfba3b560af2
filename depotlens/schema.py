"""Names, keys and types of every table the engine reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

# The source systems in lookup order; the last one also stands for any other index.
SOURCE_SYSTEMS = (
    "salesforce",
    "pdi_rightangle",
    "marketview",
    "gurobi",
    "terminals",
    "master_data_mgmt",
    "pc_miler",
    "veeder_root_sticks",
    "payroll_workday",
    "dtn_ads",
    "weather_other",
    "samsara",
)

# Table names per layer, in build order.
SOURCE = "source_operational_signals"
BRONZE = ("bronze_operational_signals",)
SILVER = (
    "silver_inventory_state",
    "silver_demand_drivers",
    "silver_dispatch_context",
)
GOLD = (
    "gold_inventory_visibility",
    "gold_planner_explainability",
    "gold_demand_forecast",
    "gold_dispatch_exposure",
    "gold_sales_context",
    "gold_ai_query_decisions",
)

POSITION = ("market_key", "terminal_id", "product_id")
OFFER = ("market_key", "product_id")
LANE = ("route_id", "market_key", "terminal_id")

# Business key of each gold table. The decision table repeats its key once per
# dispatch lane of the market, so the key identifies a decision, not a row.
KEYS = {
    "gold_inventory_visibility": POSITION,
    "gold_planner_explainability": POSITION,
    "gold_demand_forecast": OFFER,
    "gold_dispatch_exposure": LANE,
    "gold_sales_context": OFFER,
    "gold_ai_query_decisions": POSITION,
}


def signal_schema(clock: T.DataType | None = None) -> T.StructType:
    """The 20 signal columns. ``clock`` is the type of the two time columns:
    instants by default, ``TimestampNTZType()`` for zone-less Parquet."""
    clock = clock or T.TimestampType()
    text, real = T.StringType(), T.DoubleType()
    # Names and order of the columns.
    columns = {
        "id": T.LongType(),
        "source_system": text,
        "signal_timestamp": clock,
        "market_key": text,
        "terminal_id": text,
        "product_id": text,
        "route_id": text,
        "retail_location_id": text,
        "inventory_units": real,
        "demand_units": real,
        "wholesale_cost": real,
        "retail_price": real,
        "weather_index": real,
        "freight_cost": real,
        "telematics_risk": real,
        "planner_override_flag": T.BooleanType(),
        "source_record_id": text,
        "ingest_batch_id": text,
        "quality_flag": text,
        "record_created_ts": clock,
    }
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


SIGNALS = signal_schema()
