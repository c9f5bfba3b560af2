"""Repair of conversations by a run-length dynamic programme over their turns.

A row is a symbol: the class of its role's initial and its fault. Equal consecutive symbols
are runs. What the cheapest edits of a run cost, from each state of the wanted pattern
``(s?(ua)+)?`` to each other, is a matrix of the (min, +) algebra; a run of n rows is the n-th
power of its symbol's matrix, built from cached binary powers. The costs that remain to the end
are advanced run by run from the last to the first; the choices are unrolled forwards from them,
taking the ASCII-least initial that keeps the cost. Each initial leads to one state only, so
this is the least of all cheapest audits.

Stages, none of which collects a conversation:

1. Rows are damaged and grouped with equal rows of their conversation and turn, so copies are
   counted before any shuffle; a group whose role and text occur in an earlier turn is a
   duplicate. Texts stay behind, their hashes (SHA-256) stand for them.
2. The groups are dealt by ranges of (conversation, turn, role, hash), which splits a hot
   conversation, and each range is cut into pieces of at most ``PIECE`` groups. A piece yields
   its runs and one matrix of costs.
3. The matrices of a conversation's pieces are chained from its end, one small row a piece. Then
   every piece is unrolled by itself, from each state that it may begin in.
4. Texts and pieces of a conversation meet in order, in one task that streams them: the pieces'
   audits are linked and the repaired texts hashed. SHA-256 can't be computed in parts, so this
   last pass over one conversation is sequential; it holds one batch of rows and the audit.

Case table: null ids form one conversation; a null role or text is one space, as is a null id or
turn in the damage's key; rows of the same turn are taken in the order of role, then of their
text's hash; null turns come first; an empty role has no initial, so it can't be kept; repeated
rows count each; an empty table gives no row; further columns are ignored. A very long text is
held as a whole by its row only."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.llm.storage import stored

PIECE = 50_000
FAR = 1 << 40  # cost of the impossible

# states: nothing yet, after s, after u, after a; where the pattern may end; what comes next
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
# classes of initials, and the state that keeping one leads to from each state
CLASSES = "sua"
KEPT = {0: {START: SYSTEM}, 1: {START: USER, SYSTEM: USER, ASSISTANT: USER}, 2: {USER: ASSISTANT}}
SOUND, TRUNCATED, DELETED = range(3)
COST = {"K": 0, "R": 3, "D": 4, "I": 3}
UNFINISHED = 3

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def symbol(initial: int, fault: int) -> int:
    return initial * 3 + fault


@lru_cache(None)
def edits(number: int) -> tuple[tuple[str, int, int, int], ...]:
    """Edits of a row with this symbol: initial, state before and after, cost."""
    initial, fault = divmod(number, 3)
    found = [("D", state, state, COST["D"]) for state in range(4)]
    if fault != DELETED:
        more = UNFINISHED if fault == TRUNCATED else 0
        found += [("K", a, b, COST["K"] + more) for a, b in KEPT.get(initial, {}).items()]
        found += [("R", a, NEXT[a], COST["R"] + more) for a in range(4)]
    return tuple(found)


def product(a: Matrix, b: Matrix) -> Matrix:
    columns = tuple(zip(*b, strict=True))
    return tuple(tuple(min(FAR, *(x + y for x, y in zip(row, column, strict=True))) for column in columns) for row in a)


def applied(matrix: Matrix, after: Vector) -> Vector:
    return tuple(min(FAR, *(x + y for x, y in zip(row, after, strict=True))) for row in matrix)


UNIT: Matrix = tuple(tuple(0 if a == b else FAR for b in range(4)) for a in range(4))


def _inserting() -> Matrix:
    rows = []
    for a in range(4):
        costs, state, cost = [FAR] * 4, a, 0
        while cost < costs[state]:
            costs[state] = cost
            state, cost = NEXT[state], cost + COST["I"]
        rows.append(tuple(costs))
    return tuple(rows)


INSERTING = _inserting()
FINISH = applied(INSERTING, tuple(0 if state in ENDS else FAR for state in range(4)))


@lru_cache(None)
def power(number: int, exponent: int) -> Matrix:
    """The matrix of 2^exponent rows of one symbol."""
    if exponent:
        half = power(number, exponent - 1)
        return product(half, half)
    costs = [[FAR] * 4 for _ in range(4)]
    for _, a, b, cost in edits(number):
        costs[a][b] = min(costs[a][b], cost)
    return product(INSERTING, tuple(map(tuple, costs)))


@lru_cache(1 << 16)
def run_before(number: int, length: int, after: Vector) -> Vector:
    """Costs to the end before a run, from those after it."""
    for exponent in range(length.bit_length()):
        if length >> exponent & 1:
            after = applied(power(number, exponent), after)
    return after


@lru_cache(1 << 16)
def _run_matrix(number: int, length: int, after: Matrix) -> Matrix:
    for exponent in range(length.bit_length()):
        if length >> exponent & 1:
            after = product(power(number, exponent), after)
    return after


def _relative(values: Vector) -> tuple[Vector, int]:
    least = min(values)
    return tuple(min(FAR, v - least) if v < FAR else FAR for v in values), least


def piece_matrix(runs: list[tuple[int, int]]) -> Matrix:
    """Matrix of all runs. What it holds is kept relative to its least cost, so that few
    different matrices occur and each product is computed once."""
    whole, cost = UNIT, 0
    for number, length in reversed(runs):
        flat, more = _relative(sum(_run_matrix(number, length, whole), ()))
        whole, cost = tuple(flat[k : k + 4] for k in range(0, 16, 4)), cost + more
    return tuple(tuple(min(FAR, v + cost) for v in row) for row in whole)


@lru_cache(1 << 16)
def _choice(number: int, after: Vector, state: int) -> tuple[str, int]:
    """Initials of the least cheapest edits of a row, inserts before it included, and the
    state they lead to."""
    least = run_before(number, 1, after)
    text = ""
    while True:
        wanted = least[state]
        options = [(name, b) for name, a, b, cost in edits(number) if a == state and cost + after[b] == wanted]
        if COST["I"] + least[NEXT[state]] == wanted:
            options.append(("I", NEXT[state]))
        name, state = min(options)
        text += name
        if name != "I":
            return text, state


def unrolled(runs: list[tuple[int, int]], after: Vector, state: int) -> tuple[str, int]:
    """Audit of a piece that begins in ``state``, and the state it ends in."""
    after = _relative(after)[0]
    ends = [after]
    for number, length in reversed(runs):
        ends.append(_relative(run_before(number, length, ends[-1]))[0])
    audit: list[str] = []
    for (number, length), end in zip(runs, ends[-2::-1], strict=True):
        steps = [end]  # costs after each row of the run, last first
        while len(steps) < length:
            steps.append(_relative(run_before(number, 1, steps[-1]))[0])
        for costs in reversed(steps):
            text, state = _choice(number, costs, state)
            audit.append(text)
    return "".join(audit), state


def finished(state: int) -> str:
    """Inserts that end the pattern."""
    text = ""
    while state not in ENDS:
        text, state = text + "I", NEXT[state]
    return text


# rows


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the damage, without nulls in role and text."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.pmod(F.crc32(key), F.lit(20))
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    changed = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    times = F.when(kind == 3, 2).otherwise(1)
    rows = conversations.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), changed.alias("text"), times.alias("times")
    )
    return rows.withColumn("times", F.explode(F.array_repeat("times", F.col("times")))).drop("times")


_KEY = ("conv_id", "turn", "role", "digest")
_SPACES = r"[\x20\x09-\x0D]"


def _lines(rows: DataFrame) -> DataFrame:
    """One row per group of equal rows of a turn: class, fault and number of copies."""
    last = F.regexp_extract("text", rf"([^\x20\x09-\x0D]){_SPACES}*\z", 1)
    fault = F.when(last == "", DELETED).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    initial = F.lit(len(CLASSES))
    for number, letter in enumerate(CLASSES):
        initial = F.when(F.col("role").startswith(letter), number).otherwise(initial)
    grouped = (
        rows.select("conv_id", "turn", "role", _digest().alias("digest"), initial.alias("initial"), fault.alias("fault"))
        .groupBy(*_KEY, "initial", "fault").agg(F.count("*").alias("copies"))
    )
    return grouped


def _digest() -> Column:
    return F.unhex(F.sha2(F.col("text"), 256))


def _with_duplicates(lines: DataFrame) -> DataFrame:
    """``again``: the role and text occur in an earlier turn. The first turn of each role
    and text is joined back by the whole key, which no group shares with another."""
    first = lines.groupBy("conv_id", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
    first = first.select("conv_id", F.col("first.turn").alias("turn"), "role", "digest", F.lit(False).alias("again"))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"f.{c}")) for c in _KEY]
    joined = lines.alias("l").join(first.alias("f"), same, "left")
    return joined.select("l.*", F.coalesce("f.again", F.lit(True)).alias("again"))


_PIECES = (
    "conv_id {id}, piece bigint, turn {turn}, role string, digest binary, matrix array<bigint>, symbols binary,"
    " lengths binary, first int, last int, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
)


def _cut(batches: Iterator[pa.RecordBatch], types: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Pieces of the sorted groups of one range."""
    part, count = TaskContext.get().partitionId(), 0
    held: list[dict] = []
    out: list[dict] = []
    for batch in batches:
        for line in batch.to_pylist():
            if held and (line["conv_id"] != held[-1]["conv_id"] or len(held) >= PIECE):
                out.append(_piece(held, (part << 40) + count))
                held, count = [], count + 1
            held.append(line)
            if len(out) >= 1000:
                yield _batch(out, types)
                out = []
    if held:
        out.append(_piece(held, (part << 40) + count))
    if out:
        yield _batch(out, types)


def _batch(rows: list[dict], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in types.items()], names=list(types))


def _legal(a: int, b: int) -> bool:
    return (a, b) in ((0, 1), (1, 2), (2, 1))


def _piece(lines: list[dict], number: int) -> dict:
    runs: list[list[int]] = []
    counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    before = None
    for line in lines:
        initial, copies = line["initial"], line["copies"]
        fault = DELETED if line["again"] else line["fault"]
        for number_, length in ((symbol(initial, fault), 1), (symbol(initial, DELETED), copies - 1)):
            if length and runs and runs[-1][0] == number_:
                runs[-1][1] += length
            elif length:
                runs.append([number_, length])
        if line["fault"] == DELETED:
            counts["blank"] += copies
        else:
            counts["duplicate"] += copies if line["again"] else copies - 1
            counts["truncated"] += fault == TRUNCATED
        counts["illegal"] += copies - 1 + (before is not None and not _legal(before, initial))
        before = initial
    head = lines[0]
    return {
        "conv_id": head["conv_id"], "piece": number, "turn": head["turn"], "role": head["role"], "digest": head["digest"],
        "matrix": [v for row in piece_matrix([(s, n) for s, n in runs]) for v in row],
        "symbols": np.array([s for s, _ in runs], np.uint8).tobytes(), "lengths": np.array([n for _, n in runs], np.int64).tobytes(),
        "first": head["initial"], "last": lines[-1]["initial"], **counts,
    }


def _chain(batches: Iterator[pa.RecordBatch], types: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Costs after each piece, from the pieces of each conversation, last first. ``opens``
    says that no piece comes before; then ``cost`` is that of the conversation."""
    held: dict | None = None
    costs = FINISH
    for batch in batches:
        out: list[dict] = []
        for row in batch.to_pylist():
            if held is not None:
                same = row["conv_id"] == held["conv_id"]
                out.append(held | {"opens": not same})
                costs = costs if same else FINISH
            matrix = tuple(tuple(row["matrix"][k : k + 4]) for k in range(0, 16, 4))
            held = {"conv_id": row["conv_id"], "piece": row["piece"], "after": list(costs)}
            costs = applied(matrix, costs)
            held["cost"] = costs[START]
        if out:
            yield _batch(out, types)
    if held is not None:
        yield _batch([held | {"opens": True}], types)


def _unroll(batches: Iterator[pa.RecordBatch], types: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in (batch.slice(k, 100) for k in range(0, batch.num_rows, 100)):
            out = []
            for row in rows.to_pylist():
                symbols, lengths = np.frombuffer(row["symbols"], np.uint8).tolist(), np.frombuffer(row["lengths"], np.int64).tolist()
                runs = list(zip(symbols, lengths, strict=True))
                states = [START] if row["opens"] else range(4)
                found = [unrolled(runs, tuple(row["after"]), s) for s in states]
                out.append(row | {"audits": [a for a, _ in found], "states": [s for _, s in found]})
            yield _batch(out, types)


class _Conversation:
    """What is known of a conversation while its rows stream by."""

    def __init__(self, row: dict):
        self.row, self.state, self.last = row, START, None
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.audit: list[str] = []
        self.pending, self.at = "", 0
        self.hash, self.lines = hashlib.sha256(), 0
        self.written = START  # state after what was written

    def piece(self, row: dict) -> None:
        for name in ("blank", "duplicate", "truncated", "illegal"):
            self.counts[name] += row[name]
        if self.last is None:
            self.counts["cost"] = row["cost"]
        elif not _legal(self.last, row["first"]):
            self.counts["illegal"] += 1
        self.last = row["last"]
        begin = 0 if len(row["audits"]) == 1 else self.state
        self.pending, self.at, self.state = row["audits"][begin], 0, row["states"][begin]
        self.audit.append(self.pending)

    def text(self, role: str, text: str) -> None:
        while True:
            name = self.pending[self.at]
            self.at += 1
            if name == "I":
                self._write(NAMES[NEXT[self.written]], "", NEXT[self.written])
            elif name == "R":
                return self._write(NAMES[NEXT[self.written]], text, NEXT[self.written])
            elif name == "K":
                return self._write(role, text, KEPT[CLASSES.index(role[0])][self.written])
            else:
                return None

    def _write(self, role: str, text: str, state: int) -> None:
        self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines, self.written = self.lines + 1, state

    def result(self) -> dict:
        rest = finished(self.state)
        for _ in rest:
            self._write(NAMES[NEXT[self.written]], "", NEXT[self.written])
        return {"conv_id": self.row["conv_id"], "gaps": self.row["gaps"], **self.counts, "audit": "".join(self.audit) + rest, "repaired_sha256": self.hash.hexdigest()}


def _link(batches: Iterator[pa.RecordBatch], types: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    current: _Conversation | None = None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["kind"] == 0:
                if current is not None:
                    out.append(current.result())
                current = _Conversation(row)
            elif row["kind"] == 1:
                current.piece(row["line"])
            else:
                current.text(row["role"], row["text"])
        if out:
            yield _batch(out, types)
    if current is not None:
        yield _batch([current.result()], types)


def repaired(conversations: DataFrame, folder: str) -> DataFrame:
    """Faults, cost, audit and the repaired text's hash of every conversation that has
    rows before the damage; see :func:`report`."""
    return report(damaged(conversations), conversations.select("conv_id").distinct(), folder)


def report(rows: DataFrame, ids: DataFrame, folder: str) -> DataFrame:
    """The repair of ``rows`` (``conv_id, turn, role, text``), one row for each of ``ids``."""
    kinds = {f.name: f.dataType for f in rows.schema}
    id_type, turn_type = kinds["conv_id"].simpleString(), kinds["turn"].simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    arrow |= {"array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}

    def through(frame: DataFrame, task, schema: str) -> DataFrame:
        types = {name: arrow[kind] for name, kind in (column.strip().split(" ") for column in schema.split(","))}
        return frame.mapInArrow(lambda batches: task(batches, types), schema)

    order = ("conv_id", "turn", "role", "digest")
    lines = stored(_with_duplicates(_lines(rows)), folder, "lines")
    dealt = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = stored(through(dealt, _cut, _PIECES.format(id=id_type, turn=turn_type)), folder, "pieces")

    small = pieces.select("conv_id", "piece", "matrix").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("piece"))
    after = through(small, _chain, f"conv_id {id_type}, piece bigint, after array<bigint>, opens boolean, cost bigint")
    known = pieces.join(after.drop("conv_id"), "piece")
    told = "conv_id {id}, turn {turn}, role string, digest binary, first int, last int, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audits array<string>, states array<int>"
    told = told.format(id=id_type, turn=turn_type)
    audits = through(known, _unroll, told)

    turn = F.col("turn")
    gaps = lines.groupBy("conv_id").agg((F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn)).cast("long").alias("gaps"))
    every = ids.alias("i").join(gaps.alias("g"), F.col("i.conv_id").eqNullSafe(F.col("g.conv_id")), "left")
    line = F.struct("first", "last", "blank", "duplicate", "truncated", "illegal", "cost", "audits", "states")
    parts = [
        every.select("i.conv_id", F.lit(0).alias("kind"), F.coalesce("g.gaps", F.lit(0)).alias("gaps")),
        audits.select("conv_id", "turn", "role", "digest", F.lit(1).alias("kind"), line.alias("line")),
        rows.select("conv_id", "turn", "role", _digest().alias("digest"), F.lit(2).alias("kind"), "text"),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    streamed = whole.repartition("conv_id").sortWithinPartitions("conv_id", F.col("kind") > 0, "turn", "role", "digest", "kind")
    columns = streamed.select("conv_id", "kind", "gaps", "role", "text", "line")
    return through(
        columns, _link,
        f"conv_id {id_type}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string",
    )
