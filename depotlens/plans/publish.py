"""Publishing finished tables to a serving copy, with reconciliation."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlens.schema import GOLD, KEYS
from depotlens.sources.store import FolderStore

LOG = logging.getLogger(__name__)

# Serving column type per Spark type; anything else is TEXT.
SERVING_TYPES = (
    ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), "bigint", "BIGINT"),
    ((T.FloatType, T.DoubleType, T.DecimalType), "double", "DOUBLE PRECISION"),
    ((T.BooleanType,), "boolean", "BOOLEAN"),
    ((T.TimestampType, T.TimestampNTZType), "timestamp", "TIMESTAMPTZ"),
    ((T.DateType,), "date", "DATE"),
)
NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


class ReconciliationError(RuntimeError):
    """Source and serving copy of a table differ."""


def _serving(kind: T.DataType) -> tuple[str, str]:
    if isinstance(kind, NESTED):
        raise TypeError(f"{kind.simpleString()} has no serving type")
    for kinds, spark_type, serving_type in SERVING_TYPES:
        if isinstance(kind, kinds):
            return spark_type, serving_type
    return "string", "TEXT"


def serving_type(kind: T.DataType) -> str:
    return _serving(kind)[1]


def serving_columns(frame: DataFrame, zone: str = "UTC") -> DataFrame:
    """Columns cast to the types the serving side stores. Times without a zone are read
    as times of ``zone``, whatever the zone of the session."""
    columns: list[Column] = []
    for column in frame.schema:
        value = F.col(_ticked(column.name))
        if isinstance(column.dataType, T.TimestampNTZType):
            value = _instant(column.name, zone)
        columns.append(value.cast(_serving(column.dataType)[0]).alias(column.name))
    return frame.select(*columns)


def _ticked(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _instant(name: str, zone: str) -> Column:
    start = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    micros = F.expr(f"timestampdiff(MICROSECOND, {start}, {_ticked(name)})")
    return F.to_utc_timestamp(F.timestamp_micros(micros), zone)


def describe_columns(schema: T.StructType) -> list[tuple[int, str, str, str]]:
    """Position, name, Spark type and serving type of each column."""
    return [
        (position, column.name, column.dataType.simpleString(), serving_type(column.dataType))
        for position, column in enumerate(schema, start=1)
    ]


def counts(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row with the number of rows and of different keys, a NULL being a key value.

    Grouping by the key gives both in one pass, and a key that repeats very often
    is already merged on the map side."""
    if not keys:
        return frame.agg(F.count("*").alias("row_count"), F.lit(0).cast("bigint").alias("key_count"))
    per_key = frame.groupBy(*keys).agg(F.count("*").alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("row_count"),
        F.count("*").alias("key_count"),
    )


class Target(Protocol):
    def replace(self, name: str, frame: DataFrame) -> None: ...

    def counts(self, name: str, keys: Sequence[str]) -> DataFrame: ...


@dataclass(frozen=True)
class FolderTarget:
    """Serving copy as a folder of tables."""

    store: FolderStore

    def replace(self, name: str, frame: DataFrame) -> None:
        self.store.write(name, frame)

    def counts(self, name: str, keys: Sequence[str]) -> DataFrame:
        return counts(self.store.read(name), keys)


def quoted(name: str) -> str:
    """``name`` as an SQL identifier."""
    return '"' + name.replace('"', '""') + '"'


@dataclass(frozen=True)
class JdbcTarget:
    """Serving copy in a relational server, filled by the executors in parallel.

    The executors write to a staging table, each task in its own transaction. Only when
    the staging table has the rows of the source, one transaction of the driver empties
    the serving table, fills it from the staging table and drops that. So readers see the
    old table or the new one, and a repeated task is noticed before the swap. The serving
    table is created on first use and keeps its grants after that."""

    spark: SparkSession
    url: str
    schema: str = ""
    properties: Mapping[str, str] = field(default_factory=dict)
    connections: int = 16
    batch_rows: int = 10_000

    def __post_init__(self) -> None:
        if not self.url or not self.url.strip():
            raise ValueError("a JDBC url is required to publish")

    def full_name(self, name: str) -> str:
        return f"{quoted(self.schema)}.{quoted(name)}" if self.schema else quoted(name)

    def staging(self, name: str) -> str:
        return f"{name}__staging"

    def write_options(self, name: str) -> dict[str, str]:
        return {
            **self.properties,
            "url": self.url,
            "dbtable": self.full_name(self.staging(name)),
            "batchsize": str(self.batch_rows),
        }

    def create(self, name: str, columns: T.StructType) -> str:
        listed = ", ".join(f"{quoted(c.name)} {serving_type(c.dataType)}" for c in columns)
        return f"CREATE TABLE IF NOT EXISTS {self.full_name(name)} ({listed})"

    def preparation(self, name: str, columns: T.StructType) -> list[str]:
        """Statements before the executors write."""
        namespace = [f"CREATE SCHEMA IF NOT EXISTS {quoted(self.schema)}"] if self.schema else []
        staging = self.staging(name)
        return [*namespace, f"DROP TABLE IF EXISTS {self.full_name(staging)}", self.create(staging, columns)]

    def swap(self, name: str, columns: T.StructType) -> list[str]:
        """Statements of the one transaction that readers see."""
        listed = ", ".join(quoted(c.name) for c in columns)
        staging = self.full_name(self.staging(name))
        return [
            self.create(name, columns),
            f"TRUNCATE TABLE {self.full_name(name)}",
            f"INSERT INTO {self.full_name(name)} ({listed}) SELECT {listed} FROM {staging}",
            f"DROP TABLE {staging}",
        ]

    def count_query(self, name: str, keys: Sequence[str]) -> str:
        table = self.full_name(name)
        if not keys:
            return f"SELECT COUNT(*) AS row_count, 0 AS key_count FROM {table}"
        columns = ", ".join(map(quoted, keys))
        per_key = f"SELECT COUNT(*) AS copies FROM {table} GROUP BY {columns}"
        return (
            "SELECT COALESCE(SUM(copies), 0) AS row_count, COUNT(*) AS key_count "
            f"FROM ({per_key}) key_rows"
        )

    def replace(self, name: str, frame: DataFrame) -> None:
        self.execute(self.preparation(name, frame.schema))
        written = Observation()
        # dealt anew, so that the table is computed in as many tasks as it needs
        dealt = frame.observe(written, F.count("*").alias("rows")).repartition(self.connections)
        self.fill(name, dealt)
        found = self.counts(self.staging(name), ()).first()["row_count"]
        if found != written.get["rows"]:
            raise ReconciliationError(f"{name}: {written.get['rows']} rows sent, {found} staged")
        self.execute(self.swap(name, frame.schema))

    def fill(self, name: str, frame: DataFrame) -> None:
        frame.write.format("jdbc").options(**self.write_options(name)).mode("append").save()

    def execute(self, statements: Sequence[str]) -> None:
        """All statements in one transaction of the driver."""
        jvm = self.spark._jvm
        settings = jvm.java.util.Properties()
        for key, value in self.properties.items():
            settings.setProperty(key, value)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, settings)
        try:
            connection.setAutoCommit(False)
            for statement in statements:
                connection.createStatement().execute(statement)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()

    def counts(self, name: str, keys: Sequence[str]) -> DataFrame:
        """Counted by the server; only one row comes back."""
        options = {**self.properties, "url": self.url, "query": self.count_query(name, keys)}
        found = self.spark.read.format("jdbc").options(**options).load()
        return found.select(*[F.col(c).cast("bigint") for c in ("row_count", "key_count")])


def reconcile(name: str, source: DataFrame, target: Target, keys: Sequence[str]) -> DataFrame:
    """One row: rows and different keys on both sides of a table."""
    sides = {"source": counts(source, keys), "target": target.counts(name, keys)}
    labelled = [f.select(F.lit(side).alias("side"), "*") for side, f in sides.items()]
    row = labelled[0].unionAll(labelled[1]).agg(
        F.lit(name).alias("table_name"),
        *[
            F.max(F.when(F.col("side") == side, F.col(column))).alias(f"{side}_{what}")
            for what, column in (("rows", "row_count"), ("keys", "key_count"))
            for side in sides
        ],
    )
    same = (F.col("source_rows") == F.col("target_rows")) & (
        F.col("source_keys") == F.col("target_keys")
    )
    return row.select(
        "table_name", "source_rows", "target_rows", "source_keys", "target_keys", same.alias("ok")
    )


def check(name: str, source: DataFrame, target: Target, keys: Sequence[str]) -> None:
    """Raise if the serving copy has other rows or keys than the source."""
    found = reconcile(name, source, target, keys).first()
    for what in ("rows", "keys"):
        here, there = found[f"source_{what}"], found[f"target_{what}"]
        if here != there:
            raise ReconciliationError(f"{name}: {here} {what} in the source, {there} published")


def publish(
    tables: Mapping[str, DataFrame],
    target: Target,
    order: Sequence[str] = GOLD,
    keys: Mapping[str, Sequence[str]] = KEYS,
    zone: str = "UTC",
) -> list[str]:
    """Replace each serving table in turn and check it; the first failure stops the run.

    ``tables`` should be stored tables, as each is read once to write and once to
    count. The check follows the write, so a failing table stays for inspection."""
    done = []
    for name in order:
        frame = tables[name]
        if not frame.columns:
            LOG.warning("table %s has no columns, skipped", name)
            continue
        target.replace(name, serving_columns(frame, zone))
        check(name, frame, target, keys.get(name, ()))
        LOG.info("published %s", name)
        done.append(name)
    return done
