"""Shared storage of the operators: written tables that cut lineage, and binary files.

All folders lie below ``spark.checkpoint.dir``, which every executor reaches. Where one machine
is the cluster and that setting is absent (tests), a folder in the warehouse is used; elsewhere
it has to be set."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from depotlens.sources.store import shared_folder

_MADE: ContextVar[list[str] | None] = ContextVar("working_folders", default=None)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """URI of a new shared folder; it is dropped at the end of the enclosing
    :func:`working_folders`, or when the driver ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    found = path.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()
    if _MADE.get() is None:
        system.deleteOnExit(path)
    else:
        _MADE.get().append(found)
    return found


def make_folder(spark: SparkSession, uri: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


@contextmanager
def working_folders(spark: SparkSession) -> Iterator[None]:
    """Drops the folders made inside. Frames that read them must be used up by then."""
    before = _MADE.set([])
    try:
        yield
    finally:
        for folder in _MADE.get():
            drop(spark, folder)
        _MADE.reset(before)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query made inside go when it ends, not when the driver happens
    to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def drop(spark: SparkSession, uri: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(frame: DataFrame, folder: str, name: str) -> DataFrame:
    """``frame`` written as Parquet and read back, which cuts its lineage."""
    path = f"{folder}/{name}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI, from any executor. Hadoop's names of object stores
    are Arrow's own ones; other stores need a file system that Arrow knows."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")


def put(uri: str, attempt: str, write) -> None:
    """Write a file through ``write(sink)`` under a name of this attempt, then rename
    it. A repeated task replaces the file by an equal one."""
    system, path = filesystem(uri)
    part = f"{path}.{attempt}.part"
    with system.open_output_stream(part) as sink:
        write(sink)
    try:
        system.move(part, path)
    except OSError:  # some file systems don't rename onto a file
        system.delete_file(path)
        system.move(part, path)


def read_range(uri: str, start: int, length: int) -> bytes:
    system, path = filesystem(uri)
    with system.open_input_file(path) as source:
        source.seek(start)
        return source.read(length)


def file_size(uri: str) -> int:
    system, path = filesystem(uri)
    return system.get_file_info(path).size
