"""Packing of documents into sequences: cutting stock by column generation.

Documents are encoded, and cut into whole sequences and a rest. The rests' lengths are
counted in classes over all documents; a linear program over patterns (how many rests of each
class share a sequence) is solved by column generation, where the dynamic program of a
knapsack prices new patterns. Both work on the histogram, whose size is fixed. The rounded
patterns are then given to the rests, ranked within their class, group by group; groups are
bounded by hashing, so every task sees a bounded number of lengths and no text.

Classes round lengths up, so a pattern leaves a small gap. The rests that no pattern took form
a stream that is cut to fill the gaps exactly and then whole sequences; what is left of it goes
to sequences whose lengths are powers of two. No sequence needs padding unless the rests of a
group are fewer than its gaps, in which case sequences are taken apart until they suffice.

Case table: a null or empty text is its end id alone; repeated rows are packed each; rows with
a null id are packed like others; an empty table gives no piece; extra columns are left out."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.llm.storage import fresh_folder, stored
from depotlens.llm.tokens import END_ID, encoded
from depotlens.llm.words import released, spread

CAPACITY = 2048
CLASS_WIDTH = 16
GROUP_DOCUMENTS = 1 << 16
PIECES = "array<struct<start: bigint, length: bigint, sequence_id: bigint, offset: bigint>>"


@dataclass
class Pattern:
    counts: np.ndarray  # rests of each class, by class - 1
    uses: float


def _knapsack(prices: np.ndarray, units: int) -> tuple[float, np.ndarray]:
    """Most valuable pattern of classes 1..n, class c taking c of ``units``."""
    classes = len(prices)
    value, choice = np.zeros(units + 1), np.zeros(units + 1, np.int64)
    for room in range(1, units + 1):
        most = min(room, classes)
        offers = value[room - np.arange(1, most + 1)] + prices[:most]
        best = int(offers.argmax())
        if offers[best] > value[room - 1] + 1e-12:
            value[room], choice[room] = offers[best], best + 1
        else:
            value[room] = value[room - 1]
    pattern, room = np.zeros(classes), units
    while room > 0:
        if choice[room]:
            pattern[choice[room] - 1] += 1
            room -= choice[room]
        else:
            room -= 1
    return float(value[units]), pattern


def solve(histogram: np.ndarray, units: int) -> list[Pattern]:
    """Patterns and uses of the linear program: fewest sequences that take ``histogram``
    rests. Revised simplex: the basis starts with one-class patterns, duals price columns."""
    classes = len(histogram)
    columns = np.diag(units // np.arange(1, classes + 1)).astype(float)
    costs = np.ones(classes)
    inverse = np.diag(1 / np.diag(columns))
    for _ in range(50 * classes):
        duals = costs @ inverse
        worth, entering = _knapsack(np.maximum(duals, 0), units)
        cost = 1.0
        surplus = int(duals.argmin())
        if -duals[surplus] > max(worth - 1, 1e-9):
            entering, cost = np.zeros(classes), 0.0
            entering[surplus] = -1
        elif worth <= 1 + 1e-9:
            break
        direction, level = inverse @ entering, inverse @ histogram
        up = direction > 1e-9
        if not up.any():
            break
        ratios = np.where(up, np.maximum(level, 0) / np.where(up, direction, 1), np.inf)
        leaving = int(ratios.argmin())
        row = inverse[leaving] / direction[leaving]
        inverse -= np.outer(direction, row)
        inverse[leaving] = row
        columns[:, leaving], costs[leaving] = entering, cost
    uses = np.maximum(inverse @ histogram, 0)
    return [Pattern(columns[:, k].astype(np.int64), uses[k]) for k in range(classes) if costs[k] and uses[k] > 1e-9]


def _assigned(sizes: np.ndarray, patterns: list[Pattern], share: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and order of the rests that patterns take; -1 for the others."""
    sequence, slot = np.full(len(sizes), -1), np.zeros(len(sizes), np.int64)
    kind = -(-sizes // CLASS_WIDTH)
    ranked = np.argsort(kind, kind="stable")
    classes = CAPACITY // CLASS_WIDTH
    begins = np.searchsorted(kind[ranked], np.arange(1, classes + 1))
    left = np.searchsorted(kind[ranked], np.arange(1, classes + 1), side="right") - begins
    made = 0
    for pattern in sorted(patterns, key=lambda p: -p.uses):
        taken = np.flatnonzero(pattern.counts)
        copies = min(int((left[taken] // pattern.counts[taken]).min()), int(np.ceil(pattern.uses * share)))
        position = 0
        for c in taken if copies else ():
            each = int(pattern.counts[c])
            items = ranked[begins[c] : begins[c] + copies * each]
            sequence[items] = made + np.arange(copies * each) // each
            slot[items] = position + np.arange(copies * each) % each
            begins[c] += copies * each
            left[c] -= copies * each
            position += each
        made += copies
    return sequence, slot, made


def pack_group(sizes: np.ndarray, patterns: list[Pattern], share: float) -> tuple[np.ndarray, ...]:
    """Pieces of documents of ``sizes`` tokens: document, start, length, sequence, offset."""
    whole, rests = sizes // CAPACITY, sizes % CAPACITY
    document = np.repeat(np.arange(len(sizes)), whole)
    chunk = np.arange(len(document)) - np.repeat(np.cumsum(whole) - whole, whole)
    pieces = [(document, chunk * CAPACITY, np.full(len(document), CAPACITY), np.arange(len(document)), np.zeros(len(document), np.int64))]
    first = len(document)

    owners = np.flatnonzero(rests)
    lengths = rests[owners]
    sequence, slot, made = _assigned(lengths, patterns, share)
    fill = np.bincount(sequence[sequence >= 0], lengths[sequence >= 0], made).astype(np.int64)
    # take apart the last sequences until the stream fills the gaps of the others
    stream, gaps = int(lengths[sequence < 0].sum()), CAPACITY - fill
    enough = stream + fill.sum() - np.cumsum(fill) >= np.cumsum(gaps)
    kept = made if enough.all() else int(enough.argmin())
    sequence[sequence >= kept] = -1
    fill, gaps = fill[:kept], gaps[:kept]

    placed = np.flatnonzero(sequence >= 0)
    placed = placed[np.lexsort((slot[placed], sequence[placed]))]
    ends = np.cumsum(lengths[placed])
    bases = np.concatenate([[0], np.cumsum(fill)])
    offset = ends - lengths[placed] - bases[sequence[placed]]
    pieces.append((owners[placed], (sizes - rests)[owners[placed]], lengths[placed], first + sequence[placed], offset))

    loose = np.flatnonzero(sequence < 0)
    pieces.append(_streamed(owners[loose], (sizes - rests)[owners[loose]], lengths[loose], gaps, fill, first))
    return tuple(np.concatenate(c) for c in zip(*pieces, strict=True))


def _streamed(owners: np.ndarray, starts: np.ndarray, lengths: np.ndarray, gaps: np.ndarray, fill: np.ndarray, first: int):
    """The stream of loose rests, cut at the ends of gaps, whole sequences and powers of two."""
    total = int(lengths.sum())
    rest = max(0, total - int(gaps.sum()))
    tail = [1 << b for b in range(CAPACITY.bit_length() - 2, -1, -1) if rest % CAPACITY >> b & 1]
    rooms = np.concatenate([gaps, np.full(rest // CAPACITY, CAPACITY), np.array(tail, np.int64)]).astype(np.int64)
    inside = np.concatenate([fill, np.zeros(len(rooms) - len(fill), np.int64)]).astype(np.int64)
    room_ends, item_ends = np.cumsum(rooms), np.cumsum(lengths)
    cuts = np.unique(np.concatenate([[0], room_ends, item_ends, [total]]))
    cuts = cuts[cuts <= total]
    begin, size = cuts[:-1], np.diff(cuts)
    item = np.searchsorted(item_ends, begin, side="right")
    room = np.searchsorted(room_ends, begin, side="right")
    start = starts[item] + begin - (item_ends - lengths)[item]
    offset = inside[room] + begin - (room_ends - rooms)[room]
    return owners[item], start, size, first + room, offset


def plan(sizes: DataFrame, group_documents: int = GROUP_DOCUMENTS) -> DataFrame:
    """``sizes`` (``key``, ``n_tokens``, keys unique) to ``key`` and its ``pieces``."""
    rest = F.col("n_tokens") % CAPACITY
    counted = sizes.groupBy(F.ceil(rest / CLASS_WIDTH).cast("int").alias("kind")).count().collect()
    histogram = np.zeros(CAPACITY // CLASS_WIDTH)
    for kind, count in counted:
        if kind:
            histogram[kind - 1] = count
    documents = sum(count for _, count in counted)
    patterns = solve(histogram, CAPACITY // CLASS_WIDTH) if documents else []
    groups = max(1, -(-documents // group_documents))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        found = pack_group(table["n_tokens"].to_numpy(), patterns, table.num_rows / documents)
        order = np.lexsort((found[1], found[0]))
        document, start, length, sequence, offset = (c[order].astype(np.int64) for c in found)
        sequence += key[0].as_py() << 40
        each = pa.StructArray.from_arrays([pa.array(c) for c in (start, length, sequence, offset)], names=["start", "length", "sequence_id", "offset"])
        bounds = np.searchsorted(document, np.arange(table.num_rows + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(bounds), each)
        return pa.table([table["key"].combine_chunks(), lists], names=["key", "pieces"])

    group = F.pmod(F.xxhash64("key"), F.lit(groups)).alias("pack")
    rows = sizes.select(group, "key", "n_tokens")
    return rows.groupBy("pack").applyInArrow(run, f"key bigint, pieces {PIECES}")


@released
def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 512):
            part = batch.slice(first, 512)
            lists = part.column("pieces")
            each = lists.flatten()
            counts = np.asarray(lists.value_lengths())
            row = np.repeat(np.arange(part.num_rows), counts)
            start, length, sequence, offset = (each.field(k).to_numpy() for k in range(4))
            ids = [np.frombuffer(b, f"<u{w}").astype("<u4").tobytes() for b, w in zip(part.column("ids").to_pylist(), part.column("id_bytes").to_pylist(), strict=True)]
            cut = [ids[r][4 * s : 4 * (s + n)] for r, s, n in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)]
            columns = {
                "doc_id": part.column("doc_id").take(pa.array(row)),
                "start": pa.array(start),
                "length": pa.array(length),
                "doc_tokens": part.column("n_tokens").take(pa.array(row)),
                "sequence_id": pa.array(sequence),
                "offset": pa.array(offset),
                "ids": pa.array(cut, pa.binary()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def packed(documents: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their ids (little-endian unsigned 32-bit).

    The encoded documents are stored once; the plan reads their lengths only, and meets
    the ids again by key."""
    folder = fresh_folder(documents.sparkSession, "packing")
    tokens = encoded(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), path, end_id)
    kept = tokens.withColumn("n_tokens", F.length("ids") / F.col("id_bytes")).select(
        F.monotonically_increasing_id().alias("key"), "doc_id", F.col("n_tokens").cast("long").alias("n_tokens"), "ids", "id_bytes"
    )
    kept = stored(kept, folder, "tokens")
    planned = stored(plan(kept.select("key", "n_tokens")), folder, "plan")
    return kept.join(planned, "key").drop("key").mapInArrow(
        _pieces,
        "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary",
    )


def report(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
