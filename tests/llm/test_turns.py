"""Repair of conversations, against exhaustive search and SQL."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from depotlens.llm import turns
from depotlens.llm.storage import fresh_folder

SPACES = " \t\n\v\f\r"


def by_hand(rows, ids):
    """Conversations edited one row at a time, all cheapest audits compared as strings."""
    out = {}
    for conv in ids:
        mine = [r for r in rows if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        seen, faults = set(), []
        for _, _, role, text in mine:
            bare = text.strip(SPACES)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
        known = [r[1] for r in mine if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        pairs = zip(mine, mine[1:], strict=False)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in pairs)
        # best[state]: cost, audit, lines of the rest; states as in the pattern
        follow = {"": "u", "s": "u", "u": "a", "a": "u"}
        names = {"u": "user", "a": "assistant"}
        none = (10**9, "", ())

        def inserted(best):
            for _ in range(3):
                for state in best:
                    cost, audit, lines = best[follow[state]]
                    best[state] = min(best[state], (cost + 3, "I" + audit, (names[follow[state]] + ":", *lines)))
            return best

        best = inserted({s: (0, "", ()) if s in ("", "a") else none for s in follow})
        for (_, _, role, text), fault in zip(mine[::-1], faults[::-1], strict=True):
            before = {}
            for state in follow:
                cost, audit, lines = best[state]
                options = [(cost + 4, "D" + audit, lines)]
                if fault in ("", "truncated"):
                    more = 3 if fault else 0
                    if role[:1] == "s" and state == "" or role[:1] in ("u", "a") and follow[state] == role[:1]:
                        cost, audit, lines = best[role[:1]]
                        options.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
                    to = follow[state]
                    cost, audit, lines = best[to]
                    options.append((cost + more + 3, "R" + audit, (f"{names[to]}:{text}", *lines)))
                before[state] = min(options)
            best = inserted(before)
        cost, audit, lines = best[""]
        shown = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (conv, gaps, *counts, illegal, cost, audit, shown)
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check(spark, rows, ids):
    schema = "conv_id bigint, turn bigint, role string, text string"
    frame, wanted = spark.createDataFrame(rows, schema), spark.createDataFrame([(i,) for i in ids], "conv_id bigint")
    found = turns.report(frame, wanted, fresh_folder(spark, "turns")).select(*COLUMNS).collect()
    expected = by_hand(rows, ids)
    assert len(found) == len(ids)
    for row in found:
        assert tuple(row) == expected[row.conv_id]
    return {r.conv_id: r for r in found}


ROLES = ["user", "assistant", "system", "tool", "", "u", "sys", " "]
TEXTS = ["Yes.", "No", "", " \t", "Why?", "a.\n", "Stop!", "é", "x" * 5000]


@pytest.mark.parametrize("piece", [1, 3, 50_000])
def test_random_conversations(spark, monkeypatch, piece):
    pick = random.Random(piece)
    monkeypatch.setattr(turns, "PIECE", piece)
    rows = []
    for conv in [*range(60), None]:
        few = pick.randrange(1, 4)
        for turn in range(pick.randrange(1, 14)):
            turn_ = None if pick.random() < 0.1 else turn + pick.randrange(3)
            weights = [6, 6, 2, 1, 1, 1, 1, 1]
            row = (conv, turn_, pick.choices(ROLES, weights)[0], pick.choice(TEXTS[: 3 * few]))
            rows += [row] * pick.choice([1, 1, 1, 2, 4])
    check(spark, rows, [*range(60), None, 99])


def test_a_hot_conversation_of_many_equal_turns(spark, monkeypatch):
    monkeypatch.setattr(turns, "PIECE", 100)
    rows = [(7, k, "user" if k % 5 else "assistant", f"t{k % 900}.") for k in range(1500)] + [(7, 3, "user", "t3.")] * 300
    found = check(spark, [*rows, (8, 0, "system", "Hi.")], [7, 8])
    assert found[8].audit == "D" and found[7].duplicate == 900


def test_few_audits_against_all_edit_strings():
    """The least of all cheapest edit strings, found by trying every one."""
    pick = random.Random(4)

    def tried(symbols):
        best = []
        for length in range(len(symbols), len(symbols) + 4):
            for audit in itertools.product("DIKR", repeat=length):
                state, at, cost = turns.START, 0, 0
                for name in audit:
                    if name == "I":
                        state, cost = turns.NEXT[state], cost + 3
                        continue
                    ways = [e for e in turns.edits(symbols[at]) if e[0] == name and e[1] == state] if at < len(symbols) else []
                    if not ways:
                        break
                    state, cost, at = ways[0][2], cost + ways[0][3], at + 1
                else:
                    if at == len(symbols) and state in turns.ENDS:
                        best.append((cost, "".join(audit)))
        return min(best)

    for _ in range(40):
        symbols = [pick.randrange(12) for _ in range(pick.randrange(1, 4))]
        runs = [(s, len(list(g))) for s, g in itertools.groupby(symbols)]
        audit, state = turns.unrolled(runs, turns.FINISH, turns.START)
        cost = turns.applied(turns.piece_matrix(runs), turns.FINISH)[turns.START]
        assert (cost, audit + turns.finished(state)) == tried(symbols)


def test_powers_equal_steps():
    for number in range(12):
        costs = turns.FINISH
        for length in range(1, 40):
            costs = turns.run_before(number, 1, costs)
            assert turns.run_before(number, length, turns.FINISH) == costs
        assert turns.run_before(number, 10**9, turns.FINISH)[0] <= 4 * 10**9
        split = turns.applied(turns.piece_matrix([(number, 17)]), turns.run_before(number, 22, turns.FINISH))
        assert split == costs


def test_damage(spark):
    rows = [(c, t, r, x) for c in (*range(40), None) for t in (None, 0, 1, 2) for r, x in (("assistant", "A. b! c?"), (None, None))]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, kind int")
    expected = []
    for conv, turn, role, text in rows:
        role, text = role or " ", text or " "
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        row = (conv, turn, "user" if kind == 4 else role, {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text))
        expected += [row] * {0: 0, 3: 2}.get(kind, 1)
    found = [tuple(r) for r in turns.damaged(frame).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_dropped_and_empty(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    gone = next((c, 0, "user", "Hi.") for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    found = turns.repaired(spark.createDataFrame([gone], schema), fresh_folder(spark, "turns")).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in found] == [(gone[0], 0, 0, 0, 0, 0, 0, "", nothing)]
    assert turns.repaired(spark.createDataFrame([], schema), fresh_folder(spark, "turns")).collect() == []
