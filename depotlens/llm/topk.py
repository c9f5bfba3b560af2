"""Exact top-k search by a bit-sliced index.

Vectors become integers floor(scale x). The index cuts the rows into blocks of bounded size;
for each attribute of a block it holds the most significant bits of value - minimum as bitmaps
over the rows, and it keeps the integers. A query adds the bitmaps, each at the weight of its
bit and of a bit of the query's component, by carry-save adders, which gives a bit-sliced sum
for all rows of the block. The k largest sums are selected from the most significant slice
downward. The bits left out bound how far a score can lie from its sum, so the exact scores of
the selected rows give a limit that only few other rows can reach; those are found by comparing
the slices with the limit, and scored exactly. Nothing is approximate in the result.

Every query block meets every row block once; the best k of each meeting are ranked per query.

Case table: vectors that are null, hold null or non-finite components, or have a null id take
no part; vectors of another length than the query's are no candidates; rows of the query's id
are its own; repeated queries are answered each (``query_row`` tells them apart), repeated
candidates count each; ties go to the smaller id; fewer than k candidates give all; an empty
table gives no row; extra columns are ignored. Every component that is finite after scaling is
taken exactly: blocks and queries with one beyond 2^24 are computed in Python's integers, by the
same slices. Scores beyond a long are returned as the nearest long, after ranking."""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depotlens.llm.storage import file_size, put, read_range, stored

SCALE = 256
BLOCK_ROWS = 16_384
SLICES = 6
MOST_TASKS = 100_000
LARGE = 1 << 24  # products of smaller integers, for up to 2^14 attributes, fit a long
WIDE_BITS, FEW_WORDS = 64, 16  # a query of more bits is added to so many words of rows at a time


def integers(values: np.ndarray) -> np.ndarray:
    """Doubles that are whole numbers as longs, or as Python's integers if they are large."""
    if np.abs(values).max(initial=0) < LARGE:
        return values.astype(np.int64)
    return np.array([[int(v) for v in row] for row in values.tolist()], dtype=object).reshape(values.shape)


def _wide(values: np.ndarray) -> np.ndarray:
    return values if values.dtype == object else values.astype(np.int64)


def _exact_dot(values: np.ndarray, query: np.ndarray) -> np.ndarray:
    values = _wide(values)
    return (values.astype(object) if query.dtype == object else values) @ query


@dataclass
class Block:
    """Rows of one length: ids, a number of each row, integers and bit slices."""

    ids: np.ndarray
    rows: np.ndarray
    values: np.ndarray
    low: np.ndarray
    shift: int
    slices: np.ndarray  # attributes x SLICES x words of 64 rows

    @classmethod
    def build(cls, ids: np.ndarray, rows: np.ndarray, values: np.ndarray) -> Block:
        low = values.min(axis=0) if values.size else np.zeros(values.shape[1], np.int64)
        above = values - low
        shift = max(0, int(above.max(initial=0)).bit_length() - SLICES)
        coarse = (above >> shift).astype(np.uint8)
        words = -(-len(ids) // 64)
        padded = np.zeros((values.shape[1], words * 64), np.uint8)
        padded[:, : len(ids)] = coarse.T
        slices = np.stack([_bitmap(padded >> b & 1) for b in range(SLICES)], axis=1)
        kept = values if values.dtype == object else values.astype(np.int32)
        return cls(ids, rows, kept, low, shift, slices)

    def save(self, uri: str) -> None:
        """Large integers are kept as the doubles that they come from."""
        buffer = io.BytesIO()
        np.savez(buffer, **{k: v.astype(float) if getattr(v, "dtype", None) == object else v for k, v in self.__dict__.items()})
        put(uri, uuid.uuid4().hex, lambda sink: sink.write(buffer.getvalue()))

    @classmethod
    def load(cls, uri: str) -> Block:
        with np.load(io.BytesIO(read_range(uri, 0, file_size(uri)))) as found:
            values = {name: found[name] for name in found.files} | {"shift": int(found["shift"])}
        if values["values"].dtype == np.float64:
            values["values"] = integers(values["values"])
            values["low"] = integers(values["low"][None])[0].astype(object)
        return cls(**values)


def _bitmap(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)


def _rows_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _added(levels: dict[int, list[np.ndarray]], words: int) -> np.ndarray:
    """Bit-sliced sum of bitmaps (stacked, by weight), by full and half adders."""
    result, level = [], 0
    while levels:
        stack = np.concatenate(levels.pop(level, [np.empty((0, words), np.uint64)]))
        carries = levels.setdefault(level + 1, [])
        while len(stack) >= 3:
            third = len(stack) // 3
            a, b, c, rest = stack[:third], stack[third : 2 * third], stack[2 * third : 3 * third], stack[3 * third :]
            either = a ^ b
            carries.append((a & b) | (either & c))
            stack = np.concatenate([either ^ c, rest])
        if len(stack) == 2:
            carries.append(stack[:1] & stack[1:])
            stack = stack[:1] ^ stack[1:]
        result.append(stack[0] if len(stack) else np.zeros(words, np.uint64))
        level += 1
        if not carries:
            del levels[level]
    return np.stack(result)


def weighted_sum(block: Block, query: np.ndarray) -> np.ndarray:
    """Slices of sum(|q| u) over the attributes; u is the coarse value, counted from the
    top where q is negative (its bitmaps are inverted), so every term is positive."""
    words, weight = block.slices.shape[2], np.abs(query)
    bits = int(weight.max(initial=0)).bit_length()
    if bits > WIDE_BITS and words > FEW_WORDS:
        parts = [weighted_sum(replace(block, slices=block.slices[:, :, k : k + FEW_WORDS]), query) for k in range(0, words, FEW_WORDS)]
        high = max(map(len, parts))
        return np.concatenate([np.pad(part, ((0, high - len(part)), (0, 0))) for part in parts], axis=1)
    inverted = np.where(query < 0, ~np.uint64(0), np.uint64(0))
    levels: dict[int, list[np.ndarray]] = {}
    for bit in range(bits):
        chosen = np.flatnonzero(weight >> bit & 1)
        for b in range(SLICES) if len(chosen) else ():
            levels.setdefault(bit + b, []).append(block.slices[chosen, b] ^ inverted[chosen, None])
    return _added(levels, words) if levels else np.zeros((1, words), np.uint64)


def _largest(sums: np.ndarray, valid: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k largest sums, from the most significant slice downward."""
    sure, open_rows = np.zeros_like(valid), valid.copy()
    for slice_ in sums[::-1]:
        reached = sure | (open_rows & slice_)
        count = int(np.bitwise_count(reached).sum())
        if count > k:
            open_rows &= slice_
        else:
            sure, open_rows = reached, open_rows & ~slice_
            if count == k:
                return _rows_of(sure)
    rows = _rows_of(sure)
    return np.concatenate([rows, _rows_of(open_rows)[: k - len(rows)]])


def _at_least(sums: np.ndarray, valid: np.ndarray, limit: int) -> np.ndarray:
    if limit <= 0:
        return _rows_of(valid)
    if limit >> len(sums):
        return np.empty(0, np.int64)
    above, equal = np.zeros_like(valid), valid.copy()
    for level in range(len(sums) - 1, -1, -1):
        if limit >> level & 1:
            equal &= sums[level]
        else:
            above |= equal & sums[level]
            equal &= ~sums[level]
    return _rows_of(above | equal)


def best(block: Block, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and exact scores of the k best rows for ``query``, ties by id."""
    others = np.zeros(block.slices.shape[2] * 64, np.uint8)
    others[: len(block.ids)] = block.ids != query_id
    valid = _bitmap(others)
    if int(np.bitwise_count(valid).sum()) <= k:
        rows = _rows_of(valid)
    else:
        sums = weighted_sum(block, query)
        picked = _largest(sums, valid, k)
        limit = int(_exact_dot(block.values[picked], query).min())
        most, positive = (1 << SLICES) - 1, np.maximum(query, 0)
        base = int(_exact_dot(block.low[None], query)[0]) - int((positive - query).sum() * most << block.shift)
        slack = int(positive.sum()) * ((1 << block.shift) - 1)
        rows = _at_least(sums, valid, -(-(limit - base - slack) // (1 << block.shift)))
    scores = _exact_dot(block.values[rows], query)
    if scores.dtype == object:
        order = np.array(sorted(range(len(rows)), key=lambda n: (-scores[n], block.ids[rows[n]]))[:k], np.int64)
    else:
        order = np.lexsort((block.ids[rows], -scores))[:k]
    return rows[order], scores[order]


def index(vectors: DataFrame, folder: str, id_column: str, vector_column: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Block files of all vectors below ``folder``; returns the stored number of blocks
    by vector length. Rows are dealt to blocks by a hash, so that blocks stay bounded."""
    x = F.col(vector_column)
    whole = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double") * SCALE) < float("inf")))
    scaled = F.transform(x, lambda v: v.cast("double") * SCALE)
    rows = vectors.where(whole & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
        F.size(x).alias("dim"), scaled.alias("v"),
    )
    counts = rows.groupBy("dim").agg(F.ceil(F.count("*") / block_rows).alias("blocks"))
    counts = stored(counts, folder, "blocks")
    dealt = rows.join(counts, "dim").withColumn("block", F.pmod(F.xxhash64("id", "row"), "blocks"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        dim, number = (k.as_py() for k in key)
        lists = table["v"].combine_chunks()
        values = integers(np.floor(lists.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, dim)))
        Block.build(table["id"].to_numpy(), table["row"].to_numpy(), values).save(_uri(folder, dim, number))
        return pa.table({"dim": pa.array([dim], pa.int32()), "block": pa.array([number], pa.int64())})

    written = dealt.groupBy("dim", "block").applyInArrow(run, "dim int, block bigint")
    return stored(written, folder, "written")


def _uri(folder: str, dim: int, block: int) -> str:
    return f"{folder}/block-{dim}-{block}.npz"


_LONGS = -(2**63), 2**63 - 1


def _nearest_long(score: int) -> int:
    return max(_LONGS[0], min(_LONGS[1], score))


def _beyond(score: int) -> bytes | None:
    """What orders the scores that have the same nearest long, bytewise."""
    if _LONGS[0] < score < _LONGS[1]:
        return None
    size = abs(score).to_bytes((abs(score).bit_length() + 7) // 8, "big")
    key = len(size).to_bytes(4, "big") + size
    return key if score > 0 else bytes(255 - b for b in key)


def search(written: DataFrame, folder: str, k: int, every: int) -> DataFrame:
    """``k`` best rows for the indexed rows whose id is divisible by ``every``."""
    others = written.withColumnRenamed("block", "queries")
    last = written.groupBy("dim").agg(F.max("block").alias("last"))
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.col("last")))
    meetings = written.join(last, "dim").select("dim", "block", numbers.alias("queries"))
    meetings = meetings.join(others, ["dim", "queries"], "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[str, Block] | None = None
        for batch in batches:
            for dim, number, queries in zip(*(batch.column(c).to_pylist() for c in ("dim", "block", "queries")), strict=True):
                uri = _uri(folder, dim, number)
                if held is None or held[0] != uri:
                    held = uri, Block.load(uri)
                block = held[1]
                asked = block if queries == number else Block.load(_uri(folder, dim, queries))
                for q in np.flatnonzero(asked.ids % every == 0):
                    rows, scores = best(block, int(asked.ids[q]), _wide(asked.values[q]), k)
                    scores = scores.tolist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), v)) for v in (asked.ids[q], asked.rows[q])]
                        + [pa.array(block.ids[rows]), pa.array(map(_nearest_long, scores), pa.int64()), pa.array(map(_beyond, scores), pa.binary())],
                        names=["query_id", "query_row", "vec_id", "score", "beyond"],
                    )

    session = written.sparkSession
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")), min(written.count(), MOST_TASKS))
    dealt = meetings.repartition(tasks).sortWithinPartitions("dim", "block")
    found = dealt.mapInArrow(run, "query_id bigint, query_row bigint, vec_id bigint, score bigint, beyond binary")
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score", "query_row")
