"""Lasting numbers for the values of a column, so that sets of them can be kept as bitmaps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlens.sources.store import FolderStore

_BATCH_BITS = 46  # numbers of one batch: 2^13 partitions of 2^33 new values


@dataclass(frozen=True)
class Numbers:
    """Numbers of the values of ``column``, one folder of new ones per batch of a stream.

    A value keeps the number it first got. Numbers of a batch lie close together, in as few
    ranges as its new values need tasks, so that bitmaps of them are few. A batch that comes
    again replaces its own folder, before its values are numbered."""

    store: FolderStore
    column: str

    @property
    def name(self) -> str:
        return f"{self.column}_numbers"

    def _batches(self) -> list[int]:
        return sorted(int(folder.removeprefix("batch=")) for folder in self.store.finished(self.name))

    def _load(self, batches: list[int]) -> DataFrame:
        spark, kind = self.store.spark, T.StructType.fromDDL(f"`{self.column}` string, number bigint")
        paths = [self.store.path(f"{self.name}/batch={n}") for n in batches]
        return spark.read.format(self.store.format).schema(kind).load(paths) if paths else spark.createDataFrame([], kind)

    def read(self) -> DataFrame:
        return self._load(self._batches())

    def add(self, batch: int, rows: DataFrame) -> DataFrame:
        """Number the values that are new in ``rows``; all numbers up to this batch."""
        if not 0 <= batch < 1 << (63 - _BATCH_BITS):
            raise ValueError(f"batch {batch} has no numbers")
        before = [n for n in self._batches() if n < batch]
        values = rows.select(F.col(self.column).cast("string").alias(self.column)).dropna().distinct()
        new = values.join(self._load(before), self.column, "left_anti")
        numbered = new.select(self.column, (F.monotonically_increasing_id() + F.lit(batch << _BATCH_BITS)).alias("number"))
        self.store.write(f"{self.name}/batch={batch}", numbered)
        return self._load([*before, batch])

    def numbered(self, batch: int, rows: DataFrame) -> DataFrame:
        """``rows`` with the number of each value in ``<column>__number``. A hot value is on
        the small side of the join once; its rows are split by adaptive execution."""
        numbers = self.add(batch, rows).select(
            F.col(self.column).alias("__value"), F.col("number").alias(f"{self.column}__number")
        )
        return rows.join(numbers, F.col(self.column).cast("string") == F.col("__value"), "left").drop("__value")
