"""Benchmark decontamination: a Wu-Manber search for many word strings at once.

The test strings are windows of ``window`` consecutive words of an item; an item of
fewer words is one string. Strings of equal length form a set with a shift table over
blocks of two words (one word for strings of one). A scan looks at the block that ends
at its position and moves on by the block's shift; positions with shift 0 compare the
strings of the block's suffix bucket word by word.

Tables are built by tasks and kept as files in the shared folder, a block of about
``BLOCK_WINDOWS`` strings in each; an item of more is cut into overlapping segments first. A
string is a place in its item's words, so a block takes some hundred bytes a string, whatever
the benchmark's size. Nothing of the benchmark passes through the driver.

Case table: a null or word-free text has 0 words and no hit; an item without words
matches nothing; repeated items or documents each count for themselves; extra columns
pass through. Items with a null id are ignored. An empty benchmark hits nothing."""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.llm.storage import file_size, fresh_folder, put, read_range, stored
from depotlens.llm.words import LETTERED, coded, column_of, flat_bytes, hashes, mixed, released, slices, split_words, spread, strings as as_strings

WINDOW = 10
BLOCK_WINDOWS = 500_000
SEGMENT_WINDOWS = 20_000
SCANS = 4096


@dataclass
class StringSet:
    """The different test strings of one length: where each begins among the words of its
    block, the items that have it, and the search tables."""

    length: int
    block: int
    first: np.ndarray
    owners: np.ndarray  # items, string after string
    owner_starts: np.ndarray
    keys: np.ndarray
    shifts: np.ndarray
    suffixes: np.ndarray
    buckets: np.ndarray

    def items(self, string: int) -> list[int]:
        return self.owners[self.owner_starts[string] : self.owner_starts[string + 1]].tolist()


@dataclass
class Strings:
    """A block of test strings: the words of its items end to end, and the sets."""

    text: pa.Array
    words: np.ndarray
    sets: list[StringSet]

    @classmethod
    def build(cls, items: np.ndarray, texts: pa.Array, window: int = WINDOW) -> Strings:
        counts, values = split_words(texts, LETTERED)
        codes, distinct = coded(values)
        words = hashes(distinct)[codes] if len(distinct) else np.empty(0, np.uint64)
        starts, lengths = np.cumsum(counts) - counts, np.minimum(window, counts)
        sets = []
        for length in np.unique(lengths[lengths > 0]).tolist():
            rows = np.flatnonzero(lengths == length)
            windows = counts[rows] - length + 1
            sets.append(_tables(length, words, spread(starts[rows], windows), np.repeat(items[rows], windows)))
        return cls(values, words, sets)

    def save(self, uri: str) -> None:
        data, bounds = flat_bytes(self.text) if len(self.text) else (np.empty(0, np.uint8), np.zeros(1, np.int64))
        arrays = {"data": data, "bounds": bounds, "words": self.words}
        for number, one in enumerate(self.sets):
            arrays |= {f"{number}.{name}": np.asarray(value) for name, value in one.__dict__.items()}
        buffer = io.BytesIO()
        np.savez(buffer, sets=len(self.sets), **arrays)
        put(uri, uuid.uuid4().hex, lambda sink: sink.write(buffer.getvalue()))

    @classmethod
    def load(cls, uri: str) -> Strings:
        with np.load(io.BytesIO(read_range(uri, 0, file_size(uri)))) as found:
            sets = []
            for number in range(int(found["sets"])):
                values = {name.partition(".")[2]: found[name] for name in found.files if name.startswith(f"{number}.")}
                sets.append(StringSet(**values | {k: int(values[k]) for k in ("length", "block")}))
            return cls(as_strings(found["data"], found["bounds"]), found["words"], sets)


def _block_hash(words: np.ndarray, ends: np.ndarray, block: int) -> np.ndarray:
    if block == 1:
        return words[ends]
    with np.errstate(over="ignore"):
        return mixed(words[ends - 1] * np.uint64(3) + words[ends])


def _tables(length: int, words: np.ndarray, places: np.ndarray, items: np.ndarray) -> StringSet:
    """Set of the strings of ``length`` words that begin at ``places``; equal ones are one."""
    rows = np.ascontiguousarray(words[places[:, None] + np.arange(length)])
    _, index, number = np.unique(rows.view(np.dtype((np.void, 8 * length))).ravel(), return_index=True, return_inverse=True)
    first = places[index]
    order = np.lexsort((items, number))
    new = np.append(True, (np.diff(number[order]) != 0) | (np.diff(items[order]) != 0))
    order = order[new]
    owner_starts = np.searchsorted(number[order], np.arange(len(first) + 1))
    block = min(2, length)
    ends = range(block - 1, length)
    keys = [_block_hash(words, first + end, block) for end in ends]
    shifts = np.repeat(np.array([length - 1 - end for end in ends], np.int16), len(first))
    by_key = np.lexsort((shifts, np.concatenate(keys)))
    all_keys = np.concatenate(keys)[by_key]
    smallest = np.append(True, all_keys[1:] != all_keys[:-1])
    by_suffix = np.argsort(keys[-1], kind="stable")
    return StringSet(
        length, block, first, items[order], owner_starts,
        all_keys[smallest], shifts[by_key][smallest], keys[-1][by_suffix], by_suffix,
    )


def occurrences(strings: StringSet, of_items: np.ndarray, words: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(end position, string number) of every occurrence in the runs ``words[start:end]``.
    Long runs are scanned in overlapping shares, all of them in step."""
    length, block = strings.length, strings.block
    share = SCANS - SCANS // 4
    cuts = np.maximum(1, -(-(ends - starts - length + 1) // share))
    cuts[ends - starts < length] = 0
    run = np.repeat(np.arange(len(starts)), cuts)
    number = np.arange(len(run)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    at = starts[run] + number * share + length - 1
    last = np.minimum(starts[run] + (number + 1) * share + length - 1, ends[run])
    found_at, found_string = [], []
    while len(at):
        key = _block_hash(words, at, block)
        place = np.minimum(np.searchsorted(strings.keys, key), len(strings.keys) - 1)
        shift = np.where(strings.keys[place] == key, strings.shifts[place], length - block + 1)
        stop = shift == 0
        if stop.any():
            ends_here, suffix = at[stop], key[stop]
            low = np.searchsorted(strings.suffixes, suffix)
            high = np.searchsorted(strings.suffixes, suffix, side="right")
            position = np.repeat(ends_here, high - low)
            entry = np.arange(len(position)) + np.repeat(low - np.cumsum(high - low) + (high - low), high - low)
            string = strings.buckets[entry]
            same = np.ones(len(position), bool)
            for k in range(length):
                same &= words[position - length + 1 + k] == of_items[strings.first[string] + k]
            found_at.append(position[same])
            found_string.append(string[same])
        at = at + np.maximum(shift, 1)
        going = at < last
        at, last = at[going], last[going]
    if not found_at:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_at), np.concatenate(found_string)


def _search(batch: pa.RecordBatch, asked: Strings) -> pa.RecordBatch:
    """``batch`` with ``hits`` (word numbers) and ``items`` extended."""
    counts, values = split_words(column_of(batch, "row.text"), LETTERED)
    codes, distinct = coded(values)
    words = hashes(distinct)[codes] if len(distinct) else np.empty(0, np.uint64)
    ends = np.cumsum(counts)
    starts = ends - counts
    hit = [set(x or ()) for x in batch.column("hits").to_pylist()]
    items = [set(x or ()) for x in batch.column("items").to_pylist()]
    for strings in asked.sets:
        positions, found = occurrences(strings, asked.words, words, starts, ends)
        rows = np.searchsorted(ends, positions, side="right")
        for position, string, row in zip(positions.tolist(), found.tolist(), rows.tolist(), strict=True):
            first = position - strings.length + 1
            at = int(strings.first[string])
            if values[first : position + 1].to_pylist() != asked.text[at : at + strings.length].to_pylist():
                continue
            hit[row].update(range(first - int(starts[row]), position + 1 - int(starts[row])))
            items[row].update(strings.items(string))
    columns = {
        "row": batch.column("row"),
        "hits": pa.array([sorted(x) for x in hit], pa.list_(pa.int32())),
        "items": pa.array([sorted(x) for x in items], pa.list_(pa.int64())),
        "n_words": pa.array(counts, pa.int64()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _segments(window: int):
    """Lower-cased words of each item, in segments that share ``window`` - 1 words, with
    the number of strings of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                counts, values = split_words(part.column("text"), LETTERED)
                windows = np.where(counts > 0, np.maximum(counts - window + 1, 1), 0)
                cuts = -(-windows // SEGMENT_WINDOWS)
                row = np.repeat(np.arange(len(counts)), cuts)
                begin = spread(np.zeros(len(counts), np.int64), cuts) * SEGMENT_WINDOWS
                n = np.minimum(windows[row] - begin, SEGMENT_WINDOWS)
                size = np.minimum(counts[row] - begin, n + window - 1)
                start = (np.cumsum(counts) - counts)[row] + begin
                bounds = np.append(0, np.cumsum(size)).astype(np.int32)
                lists = pa.ListArray.from_arrays(bounds, values.take(pa.array(spread(start, size))).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("item").take(pa.array(row)), pc.binary_join(lists, " "), pa.array(n, pa.int64())],
                    names=["item", "text", "windows"],
                )

    return run


def _stored_strings(benchmark: DataFrame, window: int, block_windows: int, folder: str) -> list[int]:
    """Write the blocks of test strings; the numbers of those that are not empty."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item"), "text").where("item is not null")
    # an item that is repeated counts once here: its strings have the same owner
    segments = stored(items.mapInArrow(_segments(window), "item bigint, text string, windows bigint").distinct(), folder, "segments")
    total = segments.agg(F.coalesce(F.sum("windows"), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_windows))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        number = key[0].as_py()
        texts = table["text"].cast(pa.large_string()).combine_chunks()
        Strings.build(table["item"].to_numpy(), texts, window).save(_uri(folder, number))
        return pa.table({"block": pa.array([number], pa.int64())})

    dealt = segments.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    built = stored(dealt.groupBy("block").applyInArrow(run, "block bigint"), folder, "built")
    return sorted(row[0] for row in built.collect())


def _uri(folder: str, block: int) -> str:
    return f"{folder}/strings-{block}.npz"


def search(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """``row`` (a struct of the columns of ``documents``), ``hits`` (numbers of hit words),
    ``items`` (ids of occurring items) and ``n_words``.

    Documents pass once per block of about ``block_windows`` test strings, each pass but
    the last written to shared storage; a worker holds one block."""
    folder = fresh_folder(documents.sparkSession, "strings")
    blocks = _stored_strings(benchmark, window, block_windows, folder) or [None]
    found = documents.select(
        F.struct("*").alias("row"),
        F.lit(None).cast("array<int>").alias("hits"),
        F.lit(None).cast("array<bigint>").alias("items"),
        F.lit(None).cast("bigint").alias("n_words"),
    )
    for number, block in enumerate(blocks):

        @released
        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            asked = None
            for batch in batches:
                for part in slices(batch, "row.text"):
                    if asked is None:
                        asked = Strings.load(_uri(folder, block)) if block is not None else Strings(pa.array([], pa.string()), np.empty(0, np.uint64), [])
                    yield _search(part, asked)

        found = found.mapInArrow(run, found.schema)
        if number < len(blocks) - 1:
            found = stored(found, folder, f"pass{number}")
    return found


def decontaminated(documents: DataFrame, benchmark: DataFrame, most: float = 0.0, window: int = WINDOW) -> DataFrame:
    """Documents whose share of hit words is at most ``most``, columns unchanged."""
    found = search(documents, benchmark, window)
    share = F.size("hits") / F.greatest(F.col("n_words"), F.lit(1))
    return found.where(share <= most).select("row.*")


def report(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document the number of words, hit words and occurring items."""
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return search(documents.select("doc_id", "text"), benchmark, window).select(
        "row.doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
