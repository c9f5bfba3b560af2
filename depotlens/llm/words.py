"""Words of whole texts as Arrow arrays, split by byte classes without Python loops."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 2_000_000


def byte_table(separators: list[range]) -> np.ndarray:
    """Byte table: separators become a space, A-Z lower case, all else stays."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    for span in separators:
        table[list(span)] = 32
    return table


# words are [^\x20\x09-\x0D]+
SPACED = byte_table([range(0x09, 0x0E)])
# words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
LETTERED = byte_table([range(0x30), range(0x3A, 0x41), range(0x5B, 0x61), range(0x7B, 0x80)])


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` cut into runs of rows with about ``most`` bytes of text; a longer
    text is a run of its own. ``column`` may name a field of a struct, by a dot."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(column_of(batch, column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def release() -> None:
    """Gives freed memory that Arrow and the C library still hold back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # the GNU C library only
        trim(0)


def released(run: Callable) -> Callable:
    """``run`` over the batches of a task. Workers outlive their tasks, so memory that is
    free at its end is given back."""

    @wraps(run)
    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return of_task


def column_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    name, _, field = column.partition(".")
    return pc.struct_field(batch.column(name), field) if field else batch.column(name)


def unused(name: str, columns: list[str]) -> str:
    """``name``, or with underscores after it, such that no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and where each begins (n + 1 numbers).
    A null is an empty text."""
    filled = pc.fill_null(texts, "")
    if isinstance(filled, pa.ChunkedArray):
        filled = filled.combine_chunks()
    wide = filled.type in (pa.large_string(), pa.large_utf8())
    bounds = np.frombuffer(filled.buffers()[1], np.int64 if wide else np.int32)
    bounds = bounds[filled.offset : filled.offset + len(filled) + 1].astype(np.int64)
    data = filled.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, buffers)


def split_words(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Number of words of each text, and all words in order."""
    data, bounds = flat_bytes(texts)
    lists = pc.ascii_split_whitespace(strings(table[data], bounds))
    values = lists.flatten()
    filled = pc.greater(pc.binary_length(values), 0)
    before = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
    ends = np.asarray(lists.offsets) - lists.offsets[0].as_py()
    return np.diff(before[ends]), values.filter(filled)


def coded(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Values as codes into their distinct values."""
    encoded = values.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary


def hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word, the same in every process: FNV-1a byte by byte over
    all words at once, and xxh3 for the rare words over 32 bytes."""
    data, bounds = flat_bytes(words)
    starts, lengths = bounds[:-1], np.diff(bounds)
    found = np.full(len(lengths), 0xCBF29CE484222325, np.uint64)
    active = np.flatnonzero(lengths <= 32)
    for k in range(32):
        active = active[lengths[active] > k]
        if not len(active):
            break
        found[active] = (found[active] ^ data[starts[active] + k]) * np.uint64(0x100000001B3)
    for i in np.flatnonzero(lengths > 32):
        found[i] = xxhash.xxh3_64_intdigest(data[starts[i] : bounds[i + 1]].tobytes())
    return mixed(found)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every run, end to end."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts - first, lengths) + np.arange(total)
