"""Table stores: a folder of Parquet tables, or a catalog namespace."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

NAMESPACE_SETTING = "depotlens.namespace"
DEFAULT_NAMESPACE = "operations"


@dataclass(frozen=True)
class FolderStore:
    """Each table is one folder below ``root``, replaced as a whole by ``write``."""

    spark: SparkSession
    root: str
    format: str = "parquet"

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def write(self, name: str, frame: DataFrame) -> DataFrame:
        frame.write.format(self.format).mode("overwrite").save(self.path(name))
        return self.spark.read.format(self.format).schema(frame.schema).load(self.path(name))

    def append(self, name: str, frame: DataFrame) -> None:
        frame.write.format(self.format).mode("append").save(self.path(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.format(self.format).load(self.path(name))

    def read_stream(self, name: str, schema: StructType, **options: object) -> DataFrame:
        reader = self.spark.readStream.format(self.format).schema(schema)
        return reader.options(**options).load(self.path(name))

    def start(self, name: str, writer: DataStreamWriter) -> StreamingQuery:
        return writer.format(self.format).start(self.path(name))

    def finished(self, name: str) -> list[str]:
        """Names of the tables below folder ``name`` whose writing has ended."""
        system, path = _located(self, name)
        marks = system.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(path, "*/_SUCCESS"))
        return sorted(mark.getPath().getParent().getName() for mark in marks or [])

    def remove(self, name: str) -> None:
        system, path = _located(self, name)
        system.delete(path, True)


@dataclass(frozen=True)
class CatalogStore:
    """Tables of one namespace of the session catalog."""

    spark: SparkSession
    namespace: str
    format: str = "parquet"

    @classmethod
    def from_session(cls, spark: SparkSession, format: str = "parquet") -> CatalogStore:
        """Namespace named by the session setting, or the default one."""
        return cls(spark, spark.conf.get(NAMESPACE_SETTING, DEFAULT_NAMESPACE), format)

    def full_name(self, name: str) -> str:
        return f"`{self.namespace}`.`{name}`"

    def ensure(self) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.namespace}`")

    def write(self, name: str, frame: DataFrame) -> DataFrame:
        self.ensure()
        frame.write.format(self.format).mode("overwrite").saveAsTable(self.full_name(name))
        return self.read(name)

    def write_bucketed(self, name: str, frame: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
        """A table cut into ``buckets`` by a hash of ``keys`` and sorted by them, one file a
        bucket. Tables with the same keys and buckets are joined on them, and grouped by
        them, without a shuffle. A hot key fills one bucket."""
        self.ensure()
        dealt = frame.repartition(buckets, *keys).sortWithinPartitions(*keys)
        writer = dealt.write.format(self.format).mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
        writer.saveAsTable(self.full_name(name))
        return self.read(name)

    def append(self, name: str, frame: DataFrame) -> None:
        self.ensure()
        frame.write.format(self.format).mode("append").saveAsTable(self.full_name(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.full_name(name))

    def read_stream(self, name: str, schema: StructType, **options: object) -> DataFrame:
        """The schema is that of the catalog; ``schema`` only picks the columns."""
        rows = self.spark.readStream.options(**options).table(self.full_name(name))
        return rows.select(*schema.names)

    def start(self, name: str, writer: DataStreamWriter) -> StreamingQuery:
        self.ensure()
        return writer.format(self.format).toTable(self.full_name(name))


Store = FolderStore | CatalogStore


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file, or of all files below a folder; starts no job."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(found).getLength()


def on_one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``. Where one machine is the
    cluster, a folder in its warehouse will do."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not on_one_machine(spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_working"


_SCOPE: ContextVar[list[FolderStore] | None] = ContextVar("working_stores", default=None)


def working_store(spark: SparkSession) -> FolderStore:
    """A fresh folder in the shared folder. It is dropped at the end of the enclosing
    :func:`working_scope`, or when the driver ends."""
    store = FolderStore(spark, f"{shared_folder(spark).rstrip('/')}/depotlens-{uuid.uuid4().hex}")
    scope = _SCOPE.get()
    if scope is None:
        system, path = _located(store)
        system.deleteOnExit(path)
    else:
        scope.append(store)
    return store


@contextmanager
def working_scope() -> Iterator[None]:
    """Drops the working stores made inside. Frames that read them must be used up by then."""
    outer = _SCOPE.set([])
    try:
        yield
    finally:
        for store in _SCOPE.get():
            drop(store)
        _SCOPE.reset(outer)


@contextmanager
def scoped_store(spark: SparkSession) -> Iterator[FolderStore]:
    """A working store that is dropped at the end of the block."""
    with working_scope():
        yield working_store(spark)


def drop(store: FolderStore) -> None:
    system, path = _located(store)
    system.delete(path, True)


def _located(store: FolderStore, name: str | None = None):
    path = store.spark._jvm.org.apache.hadoop.fs.Path(store.path(name) if name else store.root)
    return path.getFileSystem(store.spark._jsc.hadoopConfiguration()), path
