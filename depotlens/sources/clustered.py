"""Tables whose files are ordered along a space-filling curve, with statistics to skip by.

Rows are ordered by the interleaved bits of their columns' ranks, so each file covers a small
box of all the columns at once and a filter on any of them meets few files. The extent of every
file's box is kept in a table beside the data; a filtered read looks there first and opens only
the files that may hold an asked row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.sources.store import FolderStore

BITS = 6
SAMPLE_ROWS = 20_000


def bounds(frame: DataFrame, columns: Sequence[str], bits: int = BITS, most: int = SAMPLE_ROWS) -> dict[str, list]:
    """Up to 2^bits - 1 values per column that cut its different values into even shares,
    from at most ``most`` of them. Different values are cut, not rows, so a hot value
    takes one rank only."""
    found = {}
    for column in columns:
        values = frame.select(column).dropna().distinct().orderBy(F.xxhash64(column), column).limit(most)
        ordered = sorted(row[0] for row in values.collect())
        shares = 1 << bits
        cuts = {ordered[len(ordered) * k // shares] for k in range(1, shares)} if ordered else set()
        found[column] = sorted(cuts)
    return found


def curve_position(cuts: dict[str, list], bits: int = BITS) -> Column:
    """Place of a row on the curve: the bits of its columns' ranks, the highest first."""
    place = F.lit(0).cast("bigint")
    ranks = []
    for column, values in cuts.items():
        # few values are spread over all bits, so that the highest tell them apart
        steps = [(k << bits) // (len(values) + 1) for k in range(len(values) + 1)]
        rank = F.when(F.col(column).isNull(), 0)
        for value, step in zip(values, steps, strict=False):
            rank = rank.when(F.col(column) < F.lit(value), step)
        ranks.append(rank.otherwise(steps[-1]).cast("bigint"))
    for bit in range(bits - 1, -1, -1):
        for rank in ranks:
            place = F.shiftleft(place, 1).bitwiseOR(F.shiftright(rank, bit).bitwiseAND(F.lit(1)))
    return place


@dataclass(frozen=True)
class ClusteredTable:
    """A table below ``root``, in ``files`` files or a few times that, to be asked by any of
    ``columns``."""

    spark: SparkSession
    root: str
    columns: tuple[str, ...]
    files: int = 64
    bits: int = BITS

    @property
    def store(self) -> FolderStore:
        return FolderStore(self.spark, self.root)

    def write(self, frame: DataFrame) -> None:
        """Replace the table. ``frame`` is read three times, for ranks, counts and rows, so
        it should be stored."""
        cuts = bounds(frame, self.columns, self.bits)
        depth = min(self.bits * len(self.columns), max(1, self.files.bit_length() + 2))
        cell = F.shiftright("__place", self.bits * len(self.columns) - depth)
        placed = frame.withColumn("__place", curve_position(cuts, self.bits)).withColumn("__cell", cell)
        layout = self._layout(placed)
        # at most 2^depth rows, eight for a file
        cells = F.broadcast(self.spark.createDataFrame(layout, "__cell bigint, __first int, __shares int"))
        share = F.pmod(F.xxhash64(*frame.columns, F.monotonically_increasing_id()), "__shares")
        dealt = placed.join(cells, "__cell").withColumn("__file", (F.col("__first") + share).cast("int"))
        number = max((first + shares for _, first, shares in layout), default=1)
        ordered = dealt.repartitionById(number, "__file").sortWithinPartitions("__place", *self.columns)
        rows = self.store.write("rows", ordered.select(*frame.columns))
        extents = [f(c).alias(f"{name}_{c}") for c in self.columns for f, name in ((F.min, "min"), (F.max, "max"))]
        blanks = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in self.columns]
        self.store.write("extents", rows.groupBy(F.input_file_name().alias("file")).agg(*extents, *blanks))

    def _layout(self, placed: DataFrame) -> list[tuple[int, int, int]]:
        """First file and number of files of every cell of the curve. Neighbours share a file
        while they fit, within the box of their common start; a hot cell is cut."""
        counts = sorted(tuple(row) for row in placed.groupBy("__cell").agg(F.count("*")).collect())
        size = max(1, -(-sum(n for _, n in counts) // self.files))
        layout, first, filled, box = [], 0, 0, None
        for cell, n in counts:
            if filled and (filled + n > size or cell >> len(self.columns) != box):
                first, filled = first + 1, 0
            layout.append((cell, first, max(1, -(-n // size))))
            if n > size:
                first, filled = first + layout[-1][2], 0
            else:
                filled, box = filled + n, cell >> len(self.columns)
        return layout

    def files_with(self, **asked: object) -> list[str]:
        """Files that may hold rows with these values."""
        extents = self.store.read("extents")
        for column, value in asked.items():
            if column not in self.columns:
                raise ValueError(f"{column} is none of {', '.join(self.columns)}")
            if value is None:
                extents = extents.where(F.col(f"nulls_{column}") > 0)
            else:
                extents = extents.where(F.lit(value).between(F.col(f"min_{column}"), F.col(f"max_{column}")))
        return [row["file"] for row in extents.select("file").collect()]

    def read(self, **asked: object) -> DataFrame:
        """Rows with the values asked for, from the files that may hold them."""
        rows = self.store.read("rows")
        found = self.files_with(**asked)
        part = self.spark.read.schema(rows.schema).parquet(*found) if found else rows.limit(0)
        for column, value in asked.items():
            part = part.where(F.col(column).eqNullSafe(F.lit(value)))
        return part
