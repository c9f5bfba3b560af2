"""Hard negatives by shared candidate lists of anchor clusters, exact.

Vectors become integers floor(scale x). Directions (pivots) fitted on a bounded sample deal all
rows into blocks of bounded size that lie together; a block's file keeps its vectors, and its
summary their mean direction, the widest angle to it and the largest norm. Anchors are dealt
the same way into groups of bounded size. A group's task visits the blocks by the upper bound
that the summaries give, and leaves out those that no member can use any more. In each visited
block it sorts the candidates once by their angular upper bound against the group's cone,

    norm(candidate) * cos(max(0, angle(candidate, mean) - widest angle of the members)),

and every member walks that one list until its bound certifies that nothing better follows:
below the least of its best positives in the first walk, below the band or the least of the
best negatives of each positive in the second.

A member reads a block only if its bound allows. Where vectors have no direction in common
nothing can be left out, and every group meets every block: that is the work of the stated
query set against all rows. A group's task holds its members and one block.

Equal vectors of one label are told apart by their ids alone, so a block keeps the few of each
that a result can reach, see :func:`kept_copies`; a vector that a third of the rows share is a
few rows a block.

Case table: rows with a null id, label or vector, or a null or non-finite component (also after
scaling) take no part; vectors of another length than the anchor's are no candidates; rows with
the anchor's id are the anchor's own, not its positives (nor negatives); repeated anchors
are answered each, repeated candidates count each; ties go to the smaller id, and of equal ids
to the smaller label; anchors without positives, and positives
without negatives, give no row; an empty table gives no row; extra columns are ignored. Every
finite component is taken exactly (Python integers beyond 2^53); scores beyond a long are
returned as the nearest long."""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.llm.storage import file_size, filesystem, put, read_range, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # percent of the positive's score
SAMPLE = 2_048
PIVOTS = 64
BLOCK_BYTES = 8_000_000
GROUP = 256
CACHE_BYTES = 64_000_000
STRIP = 512
MOST_TASKS = 100_000  # beyond it a task takes several groups, one after another
# the bound's relative and absolute slack for rounding in angles and norms
SLACK = 1e-6


def integers(x: np.ndarray) -> np.ndarray:
    """floor(SCALE x) as doubles that hold the integers exactly."""
    return np.floor(x * SCALE)


def norms(v: np.ndarray) -> np.ndarray:
    """Norms of rows, also where squares exceed a double."""
    top = np.abs(v).max(axis=1, initial=0)
    scale = np.where(top > 0, top, 1)
    return np.sqrt(((v / scale[:, None]) ** 2).sum(axis=1)) * scale


def directions(v: np.ndarray) -> np.ndarray:
    length = norms(v)
    return v / np.where(length > 0, length, 1)[:, None]


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of integers: in doubles, longs or Python integers,
    whichever holds them."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a @ b.T).astype(np.int64)
    if most < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    left, right = (np.array([[int(v) for v in row] for row in m], dtype=object).reshape(m.shape) for m in (a, b))
    return left @ right.T


def angles(unit: np.ndarray, direction: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ direction, -1, 1))


def cone(v: np.ndarray) -> tuple[np.ndarray, float]:
    """Mean direction of rows and the widest angle to it. A zero vector has every
    direction, as its products are zero under any bound."""
    unit = directions(v)
    mean = unit.sum(axis=0)
    length = float(np.sqrt((mean**2).sum()))
    mean = mean / length if length > 1e-9 else np.eye(1, v.shape[1]).ravel()
    return mean, float(angles(unit, mean).max(initial=0))


@dataclass
class Block:
    """Candidates in the order of their ids, and their summary."""

    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray
    mean: np.ndarray
    width: float
    norm: float

    @classmethod
    def build(cls, ids: np.ndarray, labels: np.ndarray, values: np.ndarray) -> Block:
        order = np.lexsort((labels, ids))
        mean, width = cone(values)
        return cls(ids[order], labels[order], values[order], mean, width, float(norms(values).max(initial=0)))

    def save(self, uri: str) -> None:
        buffer = io.BytesIO()
        narrow = np.int32 if np.abs(self.values).max(initial=0) < 1 << 31 else np.float64
        np.savez(buffer, ids=self.ids, labels=self.labels, values=self.values.astype(narrow))
        put(uri, uuid.uuid4().hex, lambda sink: sink.write(buffer.getvalue()))


def load(uri: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    with np.load(io.BytesIO(read_range(uri, 0, file_size(uri)))) as found:
        return found["ids"], found["labels"], found["values"].astype(np.float64)


def _double(value: int) -> float:
    """The double next to an integer; the largest one beyond that."""
    largest = float(np.finfo(float).max)
    return float(value) if abs(value) < largest else largest if value > 0 else -largest


@dataclass
class Member:
    """An anchor on its walks. What it has found is kept best first: (-score, id, label)."""

    id: int
    label: int
    positives: list[tuple] = field(default_factory=list)
    negatives: list[list[tuple]] = field(default_factory=list)

    def needed_positive(self) -> float:
        """Scores below this can't be among the positives."""
        return _double(-self.positives[-1][0]) if len(self.positives) == POSITIVES else -np.inf

    def needed_negative(self) -> float:
        """Scores below this are no negative of any positive. 2 LOW is 100, so half of a
        positive's score is the band's lower end; empty bands need nothing."""
        needs = []
        for positive, found in zip(self.positives, self.negatives, strict=True):
            least = -(positive[0] * LOW // 100)
            if len(found) == NEGATIVES:
                least = max(least, -found[-1][0])
            if positive[0] <= 0:
                needs.append(least)
        return _double(min(needs)) if needs else np.inf

    def take_positives(self, rows: list[tuple]) -> None:
        self.positives = sorted(self.positives + rows)[:POSITIVES]

    def take_negatives(self, rows: list[tuple]) -> None:
        for k, (minus, _, _) in enumerate(self.positives):
            inside = [r for r in rows if -LOW * minus <= -100 * r[0] <= -HIGH * minus]
            if inside:
                self.negatives[k] = sorted(self.negatives[k] + inside)[:NEGATIVES]


def walk(members: list[Member], values: np.ndarray, mean: np.ndarray, width: float, block: tuple, same_label: bool) -> int:
    """Let the members walk a block's list; the number of products computed."""
    ids, labels, candidates = block
    length = norms(candidates)
    apart = np.maximum(angles(directions(candidates), mean) - width, 0)
    bound = length * np.cos(apart)
    bound = bound + SLACK * (length + 1)
    order = np.argsort(-bound, kind="stable")
    own = norms(values)
    active = np.arange(len(members))
    of_member = np.array([m.label for m in members])
    id_of = np.array([m.id for m in members])
    computed = 0
    for start in range(0, len(order), STRIP):
        needed = np.array([members[k].needed_positive() if same_label else members[k].needed_negative() for k in active])
        active, needed = _still(active, needed, own, bound[order[start]])
        if not len(active):
            break
        strip = order[start : start + STRIP]
        scores = dots(values[active], candidates[strip])
        computed += scores.size
        fits = (labels[strip] == of_member[active, None]) == same_label
        fits &= (ids[strip] != id_of[active, None]) & (scores >= needed[:, None])
        for k in np.flatnonzero(fits.any(axis=1)):
            hits = np.flatnonzero(fits[k])
            rows = [(-int(s), int(i), int(c)) for s, i, c in zip(scores[k, hits], ids[strip[hits]], labels[strip[hits]], strict=True)]
            member = members[active[k]]
            member.take_positives(rows) if same_label else member.take_negatives(rows)
    return computed


def _still(active: np.ndarray, needed: np.ndarray, own: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Members that a candidate of this bound may still serve. The bound is for a
    member of norm one; negative bounds shrink towards zero with it as well."""
    with np.errstate(invalid="ignore", over="ignore"):
        reach = own[active] * bound
    reach = reach + SLACK * np.abs(reach) + SLACK
    keep = ~(reach < needed)
    return active[keep], needed[keep]


def mined(ids: np.ndarray, labels: np.ndarray, values: np.ndarray, blocks: Summaries, read, stats: dict | None = None) -> list[tuple]:
    """Result rows of a group of anchors; ``read`` gives a block by its name. ``stats``
    counts the blocks read and the products computed."""
    members = [Member(int(i), int(c)) for i, c in zip(ids, labels, strict=True)]
    mean, width = cone(values)
    own, everyone = norms(values), np.arange(len(members))
    apart = np.maximum(angles(blocks.means, mean) - blocks.widths - width, 0)
    reach = blocks.norms * np.cos(apart) + SLACK * (blocks.norms + 1)
    for same_label in (True, False):
        for number in np.argsort(-reach, kind="stable"):
            needed = np.array([m.needed_positive() if same_label else m.needed_negative() for m in members])
            left, _ = _still(everyone, needed, own, reach[number])
            if not len(left):
                break
            products = walk([members[k] for k in left], values[left], mean, width, read(blocks.names[number]), same_label)
            if stats is not None:
                stats["blocks"] = stats.get("blocks", 0) + 1
                stats["products"] = stats.get("products", 0) + products
        for member in members if same_label else ():
            member.negatives = [[] for _ in member.positives]
    return [
        (m.id, positive, rank, r[1], -minus, -r[0])
        for m in members
        for (minus, positive, _), found in zip(m.positives, m.negatives, strict=True)
        for rank, r in enumerate(found, 1)
    ]


def kept_copies(ids: np.ndarray, labels: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Rows that can occur in a result: of equal vectors of a label the first in the order
    of ids. No result needs more than ``POSITIVES`` rows of one id, nor more than so many
    besides those of an anchor's own id."""
    order = np.lexsort((ids, labels))
    if values.shape[1]:
        rows = np.ascontiguousarray(values + 0.0)  # no negative zeros
        codes = np.unique(rows.view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1]))).ravel(), return_inverse=True)[1]
    else:
        codes = np.zeros(len(ids), np.int64)
    order = order[np.argsort(codes[order], kind="stable")]
    kept = _first(np.stack([codes, labels, ids])[:, order], POSITIVES)
    order = order[kept]
    return order[_first(np.stack([codes, labels])[:, order], 2 * POSITIVES)]


def _first(keys: np.ndarray, most: int) -> np.ndarray:
    """Whether each row is among the first ``most`` of its run of equal keys."""
    new = np.ones(keys.shape[1], bool)
    new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    begins = np.flatnonzero(new)
    return np.arange(len(new)) - np.repeat(begins, np.diff(np.append(begins, len(new)))) < most


def fitted_pivots(units: np.ndarray, count: int) -> np.ndarray:
    """Directions of up to ``count`` clusters of the rows: rows far from each other first,
    then rounds of means."""
    chosen = [0]
    nearest = units @ units[0]
    while len(chosen) < min(count, len(units)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, units @ units[chosen[-1]])
    pivots = units[chosen]
    for _ in range(8):
        owner = (units @ pivots.T).argmax(axis=1)
        sums = np.zeros_like(pivots)
        np.add.at(sums, owner, units)
        length = np.sqrt((sums**2).sum(axis=1, keepdims=True))
        pivots = np.where(length > 1e-9, sums / np.where(length > 1e-9, length, 1), pivots)
    return pivots


# Spark side


def _vectors(lists: pa.Array, dim: int) -> np.ndarray:
    flat = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), dim)


def _dealt(vectors: DataFrame, folder: str) -> DataFrame:
    """Valid rows with the pivot of each, stored."""
    x = F.col("v")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double") * SCALE) < float("inf")))
    rows = vectors.where(x.isNotNull() & F.col("id").isNotNull() & F.col("label").isNotNull()).where(finite).select(
        F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "v",
        F.size(x).alias("dim"), F.monotonically_increasing_id().alias("row"),
    )
    count = rows.count()
    sample = rows.select("dim", "v", F.xxhash64("id", "row").alias("pick")).orderBy("pick", "dim").limit(SAMPLE)
    by_length: dict[int, list] = {}
    for dim, v, _ in sample.collect():  # at most SAMPLE rows
        by_length.setdefault(dim, []).append(v)
    wanted = min(PIVOTS, -(-count // SAMPLE))
    fitted = {d: fitted_pivots(directions(integers(np.array(v, np.float64).reshape(len(v), d))), wanted) for d, v in by_length.items()}
    sent = vectors.sparkSession.sparkContext.broadcast(fitted)  # at most PIVOTS directions a length, SAMPLE in all

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, lists = batch.column("dim").to_numpy(), batch.column("v")
            pivot = np.zeros(batch.num_rows, np.int32)
            for dim in np.unique(dims):
                if dim in sent.value:
                    rows = np.flatnonzero(dims == dim)
                    found = directions(integers(_vectors(lists.take(pa.array(rows)), int(dim)))) @ sent.value[dim].T
                    pivot[rows] = found.argmax(axis=1)
            yield batch.append_column("pivot", pa.array(pivot))

    kind = rows.schema["v"].dataType.simpleString()
    return stored(rows.mapInArrow(run, f"id bigint, label bigint, v {kind}, dim int, row bigint, pivot int"), folder, "rows")


def _grouped(rows: DataFrame, size, folder: str, name: str) -> DataFrame:
    """``rows`` with ``part``: by a hash of the row, so many parts of each length and
    pivot that ``size`` (rows in a part) is about met."""
    counts = rows.groupBy("dim", "pivot").agg(F.ceil(F.count("*") / size).alias("parts"))
    counts = stored(counts, folder, name)
    return rows.join(counts, ["dim", "pivot"]).withColumn("part", F.pmod(F.xxhash64("row"), "parts"))


def _write_blocks(rows: DataFrame, folder: str) -> DataFrame:
    size = F.greatest(F.lit(1), F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("dim") + 16)))
    parts = _grouped(rows, F.first(size), folder, "block_counts")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        dim, pivot, part = (k.as_py() for k in key)
        ids, labels = table["id"].to_numpy(), table["label"].to_numpy()
        values = integers(_vectors(table["v"], dim))
        kept = kept_copies(ids, labels, values)
        block = Block.build(ids[kept], labels[kept], values[kept])
        name = f"block-{dim}-{pivot}-{part}.npz"
        block.save(f"{folder}/{name}")
        columns = [pa.array([v]) for v in (name, block.mean.astype(np.float64).tobytes(), block.width, block.norm)]
        return pa.table([pa.array([dim], pa.int32()), *columns], names=["dim", "name", "mean", "width", "norm"])

    built = parts.select("id", "label", "v", "dim", "pivot", "part").groupBy("dim", "pivot", "part")
    return stored(built.applyInArrow(run, "dim int, name string, mean binary, width double, norm double"), folder, "blocks")


@dataclass
class Summaries:
    names: list[str]
    means: np.ndarray
    widths: np.ndarray
    norms: np.ndarray

    @classmethod
    def load(cls, folder: str, dim: int) -> Summaries:
        """Summaries of the blocks of one length: a direction and two numbers for every
        ``BLOCK_BYTES`` of vectors."""
        system, path = filesystem(f"{folder}/blocks")
        found = pq.read_table(path, filesystem=system, filters=[("dim", "=", dim)])
        means = np.frombuffer(b"".join(found["mean"].to_pylist()), np.float64).reshape(found.num_rows, dim)
        return cls(found["name"].to_pylist(), means, found["width"].to_numpy(), found["norm"].to_numpy())


class Cache:
    """The blocks read last, up to ``CACHE_BYTES``."""

    def __init__(self, folder: str):
        self.folder, self.held, self.size = folder, {}, 0

    def read(self, name: str) -> tuple:
        if name not in self.held:
            block = load(f"{self.folder}/{name}")
            self.size += block[2].nbytes
            while self.held and self.size > CACHE_BYTES:
                self.size -= self.held.pop(next(iter(self.held)))[2].nbytes
            self.held[name] = block
        return self.held[name]


def nearest_long(value: int) -> int:
    return max(-(2**63), min(2**63 - 1, value))


def mine(vectors: DataFrame, folder: str, every: int) -> DataFrame:
    """Hard negatives of the anchors among ``vectors`` (``id, label, v``): the rows whose id
    is divisible by ``every``."""
    rows = _dealt(vectors, folder)
    _write_blocks(rows, folder)
    anchors = _grouped(rows.where(F.col("id") % every == 0), F.lit(GROUP), folder, "group_counts")
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = [column.split()[0] for column in schema.split(", ")]

    def run(key: tuple, table: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        values = integers(_vectors(table["v"], dim))
        found = mined(table["id"].to_numpy(), table["label"].to_numpy(), values, Summaries.load(folder, dim), cache.read)
        columns = list(zip(*found, strict=True)) or [()] * len(names)
        return pa.table([pa.array([nearest_long(v) for v in c], t) for c, t in zip(columns, types, strict=True)], names=names)

    cache = Cache(folder)
    keys = ("dim", "pivot", "part")
    # groups are small and their work is not: a stated number of tasks keeps adaptive
    # execution from merging them
    groups = vectors.sparkSession.read.parquet(f"{folder}/group_counts").agg(F.sum("parts")).first()[0] or 1
    asked = anchors.select("id", "label", "v", *keys).repartition(min(int(groups), MOST_TASKS), *keys)
    return asked.groupBy(*keys).applyInArrow(run, schema)


def shifted_labels(vectors: DataFrame) -> DataFrame:
    """``id, label, v`` of the embeddings, the labels of every seventh id moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.select(F.col("vec_id").alias("id"), moved.alias("label"), F.col("embedding").alias("v"))
