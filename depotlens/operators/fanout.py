"""Many-to-many joins whose output per key can be far larger than its input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAIRS_PER_BLOCK = 4_000_000
MOST_TASKS = 200_000  # beyond it a task takes several blocks, one after another


def fan_out_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_id: Sequence[str],
    right_id: Sequence[str],
    carry: Sequence[str],
    how: str = "left",
    pairs_per_block: int = PAIRS_PER_BLOCK,
    tasks: int | None = None,
) -> DataFrame:
    """``left`` with the ``carry`` columns of every ``right`` row of the same ``key``.

    Adaptive execution splits partitions by their input bytes. Here a hot key has
    little input and much output, so its pairs are counted and cut into a grid of
    blocks: the left rows are dealt to strips by a hash of ``left_id``, the right
    rows to bands by a hash of ``right_id``, and each row is repeated along the
    other direction. Every pair meets in exactly one block. Other keys stay whole.

    ``tasks`` share the blocks; :func:`block_tasks` counts how many it takes. Without
    it ``spark.sql.shuffle.partitions`` decides.

    Only keys with rows on both sides are cut, so a left row without partner in
    one of its blocks has partners in another, and the empty block is dropped."""
    if how not in ("inner", "left"):
        raise ValueError(f"fan_out_join supports inner and left joins, not {how!r}")
    grid = _grid(left, right, key, pairs_per_block, len(carry) + 1, len(left.columns))
    strips, bands = (F.coalesce(F.col(c), F.lit(1)) for c in ("__strips", "__bands"))
    cut = F.col("__strips").isNotNull().alias("__cut")
    blocks = [key, "__strip", "__band"]

    left_rows = left.join(grid, key, "left").select(
        *left.columns, cut, _dealt(left_id, strips).alias("__strip"), _each(bands).alias("__band")
    )
    right_rows = right.join(grid, key, "left").select(
        key, *carry, _each(strips).alias("__strip"), _dealt(right_id, bands).alias("__band")
    )
    # a fixed number of partitions, as merging small ones would undo the cut
    partitions = tasks or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    paired = left_rows.repartition(partitions, *blocks).join(
        right_rows.withColumn("__met", F.lit(True)), blocks, how
    )
    kept = paired.where(F.col("__met").isNotNull() | ~F.col("__cut")) if how == "left" else paired
    return kept.select(*left.columns, *carry)


def _dealt(columns: Sequence[str], shares: Column) -> Column:
    return F.pmod(F.xxhash64(*columns), shares).cast("int")


def _each(shares: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), shares - 1))


def _sides(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of both sides for each key that both have."""
    lefts = left.groupBy(key).agg(F.count("*").alias("__left_rows"))
    return lefts.join(right.groupBy(key).agg(F.count("*").alias("__right_rows")), key)


def block_grid(
    lefts: Column, rights: Column, pairs_per_block: int, right_width: int = 1, left_width: int = 1
) -> tuple[Column, Column]:
    """Strips and bands of a key. Left rows are copied once per band, right rows once per
    strip, so for a given number of blocks the copies weigh least where both sides'
    copies weigh the same."""
    blocks = F.ceil(lefts * rights / F.lit(pairs_per_block))
    balanced = F.sqrt(blocks * rights * F.lit(right_width) / (lefts * F.lit(left_width)))
    bands = F.greatest(F.lit(1), F.least(rights, blocks, F.ceil(balanced)))
    strips = F.greatest(F.lit(1), F.least(lefts, F.ceil(blocks / bands)))
    return strips.cast("int"), F.greatest(bands, F.ceil(blocks / strips)).cast("int")


def _grid(
    left: DataFrame, right: DataFrame, key: str, pairs_per_block: int, right_width: int, left_width: int
) -> DataFrame:
    """Strips and bands of the hot keys: at most all pairs / ``pairs_per_block`` rows."""
    lefts, rights = F.col("__left_rows"), F.col("__right_rows")
    strips, bands = block_grid(lefts, rights, pairs_per_block, right_width, left_width)
    hot = _sides(left, right, key).where(lefts * rights > pairs_per_block)
    return hot.select(key, strips.alias("__strips"), bands.alias("__bands"))


def block_tasks(left: DataFrame, right: DataFrame, key: str, pairs_per_block: int = PAIRS_PER_BLOCK) -> int:
    """Tasks that keep each at about one block of pairs. Reads one aggregated row, so the
    sides should be stored tables."""
    pairs = F.col("__left_rows") * F.col("__right_rows")
    total = _sides(left, right, key).agg(F.sum(pairs.cast("decimal(38,0)"))).first()[0] or 0
    return int(min(max(1, -(-int(total) // pairs_per_block)), MOST_TASKS))
