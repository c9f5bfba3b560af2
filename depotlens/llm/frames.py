"""Token files: one zstandard frame per document, and a seek table.

A file holds the documents of one range of ids in order. Every document is an independent
frame of its ids; the last data frame holds the document ids (int64) and a byte per document
that tells a null id. The file ends with the seek table of the public seekable format of
zstandard: a skippable frame with compressed size, size and checksum of every frame, and a
footer. A reader fetches the footer, the table and the index, and then only the frames of the
documents it wants, whose checksums it compares.

Case table: a null or empty text has the end id alone; null ids come first; rows of one id
are ordered by a hash of their text, equal rows are equal wherever they stand; an empty table
gives no file; extra columns are left out."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.llm.storage import file_size, put, read_range
from depotlens.llm.tokens import END_ID, encoder, with_end
from depotlens.llm.words import slices

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE, HAS_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
_FOOTER = struct.Struct("<IBI")
_ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])

LEVEL = 3
READ_BYTES = 8_000_000
MANIFEST = "file string, part int, documents bigint, tokens bigint"


class FrameWriter:
    """Appends frames to a sink and remembers their seek table."""

    def __init__(self, sink) -> None:
        self.sink, self.entries = sink, []
        self.pack = zstandard.ZstdCompressor(level=LEVEL).compress

    def frame(self, content: bytes) -> None:
        packed = self.pack(content)
        self.sink.write(packed)
        self.entries.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def close(self) -> None:
        table = np.array(self.entries, _ENTRY).tobytes()
        footer = _FOOTER.pack(len(self.entries), HAS_CHECKSUMS, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)


@dataclass
class FrameFile:
    """A token file opened by its end; documents are read on request."""

    uri: str
    entries: np.ndarray
    offsets: np.ndarray
    ids: list[int | None]

    @classmethod
    def open(cls, uri: str) -> FrameFile:
        size = file_size(uri)
        count, flags, magic = _FOOTER.unpack(read_range(uri, size - _FOOTER.size, _FOOTER.size))
        if magic != SEEKABLE or not flags & HAS_CHECKSUMS:
            raise ValueError(f"{uri} does not end with a seek table with checksums")
        start = size - _FOOTER.size - count * _ENTRY.itemsize
        entries = np.frombuffer(read_range(uri, start, count * _ENTRY.itemsize), _ENTRY)
        offsets = np.concatenate([[0], np.cumsum(entries["packed"], dtype=np.int64)])
        index = _unpacked(read_range(uri, int(offsets[-2]), int(entries["packed"][-1])), entries[-1])
        documents = count - 1
        ids = np.frombuffer(index, "<i8", documents)
        null = np.frombuffer(index, np.uint8, documents, 8 * documents)
        return cls(uri, entries, offsets, [None if n else int(i) for i, n in zip(ids, null, strict=True)])

    def sizes(self) -> np.ndarray:
        """Tokens of each document, from the table alone."""
        return self.entries["size"][:-1].astype(np.int64) // 4

    def documents(self, first: int, last: int) -> list[bytes]:
        """The ids of documents ``first`` to ``last - 1``, by one read."""
        if first == last:
            return []
        start = int(self.offsets[first])
        packed = read_range(self.uri, start, int(self.offsets[last]) - start)
        cuts = self.offsets[first : last + 1] - start
        return [_unpacked(packed[a:b], e) for a, b, e in zip(cuts[:-1], cuts[1:], self.entries[first:last], strict=True)]

    def find(self, doc_id: int) -> list[bytes]:
        """The ids of every row of one document; reads only their frames."""
        return [self.documents(k, k + 1)[0] for k, found in enumerate(self.ids) if found == doc_id]

    def runs(self, most: int = READ_BYTES) -> Iterator[tuple[int, int]]:
        """Runs of documents of about ``most`` unpacked bytes."""
        ends = np.cumsum(self.entries["size"][:-1], dtype=np.int64)
        first = 0
        while first < len(ends):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield first, last
            first = last


def _unpacked(packed: bytes, entry: np.void) -> bytes:
    content = zstandard.ZstdDecompressor().decompress(packed, max_output_size=int(entry["size"]))
    if len(content) != entry["size"] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != entry["check"]:
        raise ValueError("a frame does not have the size and checksum of its seek table")
    return content


def write(documents: DataFrame, folder: str, path: str, end_id: int = END_ID) -> DataFrame:
    """Token files of ``documents`` below ``folder``; returns the plan of their manifest,
    which must be stored before it is used (the tasks that compute it write the files).

    Range partitions by id, and by a hash of the text for rows of one id. A repeated task
    writes the same file again under the same name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        uri = f"{folder}/tokens-{part:06d}.zst"
        source = (piece for batch in batches for piece in slices(batch))
        first = next(source, None)
        if first is None:
            return
        totals = [0, 0]

        def fill(sink) -> None:
            out, words = FrameWriter(sink), encoder(path)
            ids: list[pa.Array] = []
            piece = first
            while piece is not None:
                tokens, bounds = with_end(*words.encode(piece.column("text")), end_id)
                content, cuts = tokens.astype("<u4").tobytes(), (4 * bounds).tolist()
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    out.frame(content[a:b])
                ids.append(piece.column("doc_id"))
                totals[0] += piece.num_rows
                totals[1] += len(tokens)
                piece = next(source, None)
            every = pa.chunked_array(ids, pa.int64())
            shown = every.fill_null(0).to_numpy().astype("<i8")
            out.frame(shown.tobytes() + every.is_null().to_numpy().astype(np.uint8).tobytes())
            out.close()

        put(uri, attempt, fill)
        yield pa.RecordBatch.from_arrays(
            [pa.array([uri]), pa.array([part], pa.int32()), pa.array([totals[0]], pa.int64()), pa.array([totals[1]], pa.int64())],
            names=["file", "part", "documents", "tokens"],
        )

    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    dealt = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return dealt.select("doc_id", "text").mapInArrow(run, MANIFEST)


def read(manifest: DataFrame) -> DataFrame:
    """Every document of the files of a stored manifest: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens`` and ``ids``.

    The manifest has one row per file, few even for many documents; the ids before each
    file are summed over it on the driver."""
    spark = manifest.sparkSession
    files = manifest.orderBy("part").select("file", "tokens").collect()
    placed, before = [], 0
    for file, tokens in files:
        placed.append((file, before))
        before += tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                file = FrameFile.open(uri)
                sizes = file.sizes()
                starts = start + np.cumsum(sizes) - sizes
                for first, last in file.runs():
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(file.ids[first:last], pa.int64()),
                            pa.array(starts[first:last]),
                            pa.array(sizes[first:last]),
                            pa.array(file.documents(first, last), pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    listed = spark.createDataFrame(placed, "file string, start bigint")
    tasks = max(1, len(placed))
    return listed.repartition(tasks).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
