"""Where two copies of a table differ.

Both sides are cut into buckets by a hash of the key, and every bucket gets a fingerprint: its
rows, and the sum of their hashes, which no order changes. Only rows of buckets whose
fingerprints differ are looked at one by one, so copies that are nearly equal cost two scans
and a comparison of as many rows as there are buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.plans.publish import ReconciliationError

BUCKETS = 4096
LOST, ADDED, CHANGED = "lost", "added", "changed"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("bucket")


def _row_hash(columns: Sequence[str]) -> Column:
    """Hash of a row in which a null counts by its place."""
    marks = [F.col(f"`{c}`").isNull() for c in columns]
    return F.xxhash64(*(F.col(f"`{c}`") for c in columns), *marks)


def fingerprints(frame: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``bucket, row_count, hash_sum``, at most ``buckets`` rows; partial first."""
    columns = sorted(frame.columns)
    hashed = frame.select(_bucket(keys, buckets), _row_hash(columns).cast("decimal(20,0)").alias("hash"))
    return hashed.groupBy("bucket").agg(F.count("*").alias("row_count"), F.sum("hash").alias("hash_sum"))


def differing_buckets(source: DataFrame, target: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    here, there = (fingerprints(frame, keys, buckets) for frame in (source, target))
    both = here.alias("s").join(there.alias("t"), "bucket", "full")
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ("row_count", "hash_sum")]
    return both.where(~(same[0] & same[1])).select("bucket")


def differences(source: DataFrame, target: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Keys whose rows differ, each with ``difference``: ``lost`` (rows of the source only),
    ``added`` (rows of the target only) or ``changed`` (both), and how many rows are on one
    side only. Keys need not be unique; equal rows are counted. A null is a key value."""
    if set(source.columns) != set(target.columns):
        raise ValueError("the copies have different columns")
    columns = sorted(source.columns)
    # at most ``buckets`` numbers
    wanted = F.broadcast(differing_buckets(source, target, keys, buckets))
    sides = []
    for frame, sign in ((source, 1), (target, -1)):
        rows = frame.select(*columns, _bucket(keys, buckets)).join(wanted, "bucket", "left_semi")
        sides.append(rows.select(*columns, F.lit(sign).alias("side")))
    # equal rows cancel out, wherever they are many
    left = sides[0].unionAll(sides[1]).groupBy(*columns).agg(F.sum("side").alias("surplus")).where("surplus <> 0")
    per_key = left.groupBy(*keys).agg(
        F.sum(F.greatest("surplus", F.lit(0))).alias("source_only"),
        F.sum(F.greatest(-F.col("surplus"), F.lit(0))).alias("target_only"),
    )
    kind = F.when(F.col("target_only") == 0, LOST).when(F.col("source_only") == 0, ADDED).otherwise(CHANGED)
    return per_key.select(*keys, kind.alias("difference"), "source_only", "target_only")


def check_equal(name: str, source: DataFrame, target: DataFrame, keys: Sequence[str]) -> None:
    """Raise if any row differs, also where counts of rows and keys agree."""
    found = differing_buckets(source, target, keys).count()
    if found:
        first = differences(source, target, keys).orderBy(*keys).first()
        shown = "/".join(str(first[key]) for key in keys) if first else "?"
        raise ReconciliationError(f"{name}: rows differ in {found} buckets, first {shown} {first['difference'] if first else ''}")
