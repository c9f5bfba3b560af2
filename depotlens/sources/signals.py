"""Signals from order data, and the landing of signal batches."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.functions.scalars import padded_code, source_name, time_ordered_id, time_stamp
from depotlens.operators.spread import dealt
from depotlens.schema import SIGNALS, SOURCE
from depotlens.sources.store import Store, stored_bytes


# Columns of the order tables that signals are made of; a typed read needs no look at the files.
ORDER_TABLES = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_shipdate timestamp_ntz"
    ),
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(ORDER_TABLES[name]).parquet(f"{folder}/{name}.parquet")


# Of the stored lines, for each task that works on rows in proportion to them.
BYTES_PER_TASK = 4 << 20


def line_tasks(spark: SparkSession, folder: str) -> int:
    """Tasks that keep each at some 300,000 order lines, from the size of their files."""
    return -(-stored_bytes(spark, f"{folder}/lineitem.parquet") // BYTES_PER_TASK)


# Batches land at least a minute apart, which leaves a batch room for 6 billion ids.
BATCH_SPAN_MS = 60_000


def conform_signals(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    batch_tag: str = "orders",
    wide: bool = False,
    priced: bool = False,
    tasks: int = 0,
) -> DataFrame:
    """One signal per order line. With ``wide`` every supplier is a terminal and every
    customer a location, so that the groups grow with the data. With ``priced`` the
    measures come from the lines' prices, whose sums are not exact in doubles.

    Orders meet customers first, as that side is narrow and has one row per order;
    the large line table is then shuffled once. Orders and lines grow together, so
    neither is worth a broadcast: the merge join spills, and its skew is split. Where
    ``tasks`` are more than a shuffle of the session has, both sides are dealt to so many
    tasks, so that what a task sorts doesn't grow with the data; an order is then one task's."""
    tag = _checked_tag(batch_tag)
    buyers = customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    placed = orders.select("o_orderkey", "o_custkey", "o_orderdate").join(buyers, "o_custkey")
    placed = dealt(placed, tasks, "o_orderkey")
    lines = dealt(lineitem, tasks, "l_orderkey").join(placed.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))

    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    part, supplier, nation = F.col("l_partkey"), F.col("l_suppkey"), F.col("c_nationkey")
    route, quantity = order % 5, F.col("l_quantity")
    record = order * 8 + line
    terminal, location = supplier, F.col("o_custkey")
    if not wide:
        terminal, location = terminal % 6, location % 12
    columns = {
        "id": record,
        "source_system": F.when(order % 97 != 0, source_name(order % 12)),
        "signal_timestamp": F.col("l_shipdate"),
        "market_key": padded_code("MKT-", nation, 2),
        "terminal_id": padded_code("TRM-", terminal, 3),
        "product_id": padded_code("PRD-", part % 8, 2),
        "route_id": padded_code("RTE-", route, 3),
        "retail_location_id": padded_code("LOC-", location, 4),
        "inventory_units": F.lit(350.0) + part % 8 * 60 + quantity * 4,
        "demand_units": F.lit(120.0) + nation * 3 + quantity,
        "wholesale_cost": F.lit(150.0) + line * 5,
        "retail_price": F.lit(3.0) + _sixty_fourths(supplier % 32),
        "weather_index": _sixty_fourths(nation % 5 * 12 + line),
        "freight_cost": F.when(route != 4, F.lit(25.0) + route * 25 + quantity / 2),
        "telematics_risk": _sixty_fourths(supplier % 6 * 10 + line),
        "planner_override_flag": F.col("l_returnflag") == "R",
        "source_record_id": _record_label(tag, record),
        "ingest_batch_id": F.lit(f"BATCH-{tag}"),
        "quality_flag": F.when(line == 7, "warning").otherwise("ok"),
        "record_created_ts": F.col("o_orderdate"),
    }
    if priced:
        price, off, tax = (F.col(f"l_{c}") for c in ("extendedprice", "discount", "tax"))
        columns |= {
            "inventory_units": price * off,
            "demand_units": price * tax,
            "wholesale_cost": price * (F.lit(1.0) - off),
            "retail_price": price * (F.lit(1.0) - off) * (F.lit(1.0) + tax) / F.lit(100.0),
            "weather_index": off * tax * F.lit(99.0),
            "freight_cost": F.when(route != 4, price * off * tax),
            "telematics_risk": off / (F.lit(1.0) + tax),
        }
    return lines.select(*[columns[field.name].alias(field.name) for field in SIGNALS])


def signals_from(
    spark: SparkSession, folder: str, batch_tag: str = "orders", wide: bool = False, priced: bool = False
) -> DataFrame:
    tables = (read_table(spark, folder, name) for name in ORDER_TABLES)
    return conform_signals(*tables, batch_tag=batch_tag, wide=wide, priced=priced, tasks=line_tasks(spark, folder))


def stamp_batch(
    signals: DataFrame,
    batch_tag: str,
    landed_at: datetime | Column,
    span_ms: int = BATCH_SPAN_MS,
) -> DataFrame:
    """Lineage of one landed batch. ``landed_at`` is an instant, given by the caller
    so that a repeated attempt stamps the same batch the same way; the next batch must
    not land within ``span_ms`` of it."""
    tag = _checked_tag(batch_tag)
    moment = landed_at if isinstance(landed_at, Column) else F.lit(landed_at)
    clock = signals.schema["record_created_ts"].dataType
    return signals.withColumns(
        {
            "id": time_ordered_id(moment, F.col("id"), span_ms),
            "source_record_id": _record_label(tag, F.col("id")),
            "ingest_batch_id": F.concat(F.lit(f"BATCH-{tag}-"), time_stamp(moment)),
            "record_created_ts": moment.cast(clock),
        }
    )


def replay_batch(signals: DataFrame, until: datetime | Column, hours: int) -> DataFrame:
    """The signals as if they had come within the last ``hours`` hours before ``until``, one
    hour after another by their id."""
    if hours < 1:
        raise ValueError("hours must be at least 1")
    moment = until if isinstance(until, Column) else F.lit(until)
    clock = signals.schema["signal_timestamp"].dataType
    back = -F.pmod(F.col("id"), F.lit(hours)).cast("int")
    return signals.withColumn("signal_timestamp", F.timestamp_add("HOUR", back, moment.cast(clock)))


def append_batch(signals: DataFrame, store: Store, even_files: bool = True) -> None:
    """Add a batch to the source table. Its files must never be rewritten: a
    stream would take them for new ones and read the same signals again.

    ``even_files`` sizes the files by adaptive execution, for one more shuffle."""
    ordered = signals.select(*SIGNALS.names)
    store.append(SOURCE, ordered.hint("rebalance") if even_files else ordered)


def _checked_tag(batch_tag: str) -> str:
    tag = str(batch_tag).strip()
    if not tag:
        raise ValueError("batch_tag must not be blank")
    return tag


def _record_label(tag: str, number: Column) -> Column:
    return F.concat(F.lit(f"SRC-{tag}-"), number.cast("string"))


def _sixty_fourths(number: Column) -> Column:
    return number / F.lit(64.0)
