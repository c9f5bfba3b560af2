"""Mergeable parts, and averages that no order changes."""

from __future__ import annotations

import itertools
import os
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from rows import as_set, signals

from depotlens.operators.measures import ExactMean, Mean, State, families, merged_parts, rollup
from depotlens.operators.states import EXACT_STATES, STATES
from depotlens.plans.graph import family_parts, states_from_parts
from depotlens.schema import SILVER
from depotlens.sources.parts import Parts, Span
from depotlens.sources.signals import signals_from
from depotlens.sources.store import FolderStore


def test_fifty_small_batches_leave_few_folders(spark, data, tmp_path):
    store = FolderStore(spark, str(tmp_path / "parts"))
    frame = signals_from(spark, data, priced=True).limit(1500).cache()
    share = F.pmod(F.xxhash64("id", "signal_timestamp"), F.lit(50))
    family = families(EXACT_STATES)[1]
    for number in range(50):
        part = rollup(frame.where(share == number).coalesce(1), family.values())
        family_parts(store, family, fan_in=4).add(number, part)
        left = [f for f in os.listdir(store.path(next(iter(family)) + "_parts"))]
        assert len(left) <= 10
    assert len(left) == 5  # 50 is 302 in base 4
    rolled = family_parts(store, family).read()
    for name, state in family.items():
        assert as_set(state.from_rollup(rolled)) == as_set(state.from_signals(frame)), name
    frame.unpersist()


def counted(spark, tmp_path, fan_in=3):
    parts = Parts(FolderStore(spark, str(tmp_path)), "n", lambda rows: rows.groupBy("k").agg(F.sum("v").alias("v")), fan_in)
    return parts, lambda n, v=1: parts.add(n, spark.createDataFrame([(0, v)], "k int, v bigint").coalesce(1))


def total(parts):
    return parts.read().agg(F.sum("v")).first()[0]


def test_a_batch_that_comes_again(spark, tmp_path):
    parts, add = counted(spark, tmp_path)
    for n in range(4):
        add(n)
    add(3, 5)  # not merged yet: replaced
    assert total(parts) == 8
    add(1, 100)  # merged: passed over
    assert total(parts) == 8
    assert parts.spans() == [Span(0, 2, 1), Span(3, 3, 0)]


def test_a_merge_that_dies(spark, tmp_path, monkeypatch):
    parts, add = counted(spark, tmp_path)
    add(0), add(1)
    for step in ("write", "remove"):
        with monkeypatch.context() as patched:

            def dies(self, name, *rest, step=step):
                if step == "remove" or "merged" in name:
                    raise RuntimeError("killed")
                return plain(self, name, *rest)

            plain = getattr(FolderStore, step)
            patched.setattr(FolderStore, step, dies)
            with pytest.raises(RuntimeError, match="killed"):
                add(2)
        assert total(parts) == 3
    add(2)
    assert total(parts) == 3 and os.listdir(tmp_path / "n") == ["merged=1-0-2"]


def test_an_unfinished_folder_is_not_read(spark, tmp_path):
    parts, add = counted(spark, tmp_path)
    add(0)
    os.makedirs(tmp_path / "n" / "batch=1")
    assert parts.spans() == [Span(0, 0, 0)] and total(parts) == 1
    with pytest.raises(ValueError, match="fan_in"):
        Parts(parts.store, "n", parts.merge, 1)


def test_batches_may_be_missing(spark, tmp_path):
    parts, add = counted(spark, tmp_path, 2)
    for n in (3, 7, 8, 20, 21):
        add(n)
    assert total(parts) == 5
    assert parts.spans() == [Span(3, 20, 2), Span(21, 21, 0)]


# exact averages


def rows(seed=1, groups=40):
    pick = random.Random(seed)
    out = []
    for g in range(groups):
        size = 10 ** pick.uniform(-8, 17)
        for _ in range(pick.randrange(1, 120)):
            out.append((g, pick.choice((1, -1, 1)) * pick.random() * size if pick.random() < 0.95 else None))
    return out


def cut(x):
    return Fraction(int(abs(Fraction(x)) * 2**62), 2**62) * (1 if x >= 0 else -1)


STATE = State(keys=("g",), measures={"m": ExactMean("x")})


def means(frame):
    return {r.g: repr(r.m) for r in frame.collect()}


def test_averages_are_the_rounded_exact_sums(spark):
    data = rows()
    found = means(STATE.from_signals(spark.createDataFrame(data, "g int, x double")))
    for g, values in itertools.groupby(data, lambda r: r[0]):
        known = [x for _, x in values if x is not None]
        assert found[g] == repr(float(sum(map(cut, known))) / len(known) if known else None)


def test_averages_of_any_order_and_any_parts(spark):
    data = rows(2, 10)
    frame = spark.createDataFrame(data, "g int, x double")
    wanted = means(STATE.from_signals(frame))
    random.Random(3).shuffle(data)
    for shares in (1, 2, 5):
        other = spark.createDataFrame(data, "g int, x double").repartition(shares)
        assert means(STATE.from_signals(other)) == wanted
        split = [rollup(other.where(F.pmod(F.xxhash64("x"), F.lit(shares)) == k), [STATE]) for k in range(shares)]
        whole = split[0]
        for part in split[1:]:
            whole = whole.unionByName(part)
        assert means(STATE.from_rollup(whole)) == wanted
        assert means(STATE.from_rollup(merged_parts(whole, [STATE]))) == wanted


def test_averages_at_the_ends(spark):
    nan, inf = float("nan"), float("inf")
    cases = {
        0: [None], 1: [nan, 1.0], 2: [inf, 5.0], 3: [inf, -inf], 4: [1e30, 1.0], 5: [-0.1, 0.1], 6: [2.0**61] * 3,
        7: [-(2.0**61), -1.5], 8: [0.0, -0.0], 9: [2.0**-62], 10: [1e-30], 11: [2.0**53 + 2, 0.5], 12: [1e16, 1.0, -1e16],
    }
    wanted = {
        0: None, 1: nan, 2: inf, 3: nan, 4: 5e29, 5: 0.0, 6: 2.0**61, 7: (-(2.0**61) - 1.5) / 2, 8: 0.0, 9: 2.0**-62, 10: 0.0,
        11: (2.0**53 + 2) / 2, 12: 1 / 3,
    }
    frame = spark.createDataFrame([(g, x) for g, v in cases.items() for x in v], "g int, x double")
    assert means(STATE.from_signals(frame)) == {g: repr(v) for g, v in wanted.items()}
    empty = spark.createDataFrame([], "g int, x double")
    assert STATE.from_signals(empty).count() == 0


def test_a_limit_does_not_depend_on_the_order(spark):
    """Doubles summed one way reach a limit, the other way they don't."""
    values = [0.1] * 10 + [1e16, -1e16]
    frames = [spark.createDataFrame([(0, x) for x in v], "g int, x double").coalesce(1) for v in (values, values[::-1])]
    plain = State(keys=("g",), measures={"m": Mean("x")})
    assert len({means(plain.from_signals(f))[0] for f in frames}) == 2
    assert {means(STATE.from_signals(f))[0] for f in frames} == {repr(float(sum(map(cut, values))) / 12)}


def test_exact_states_have_the_columns_of_the_plain_ones(spark):
    frame = signals(spark, {"id": 1}, {"id": 2, "freight_cost": None, "retail_location_id": None})
    for name, state in STATES.items():
        exact = EXACT_STATES[name].from_signals(frame)
        assert exact.dtypes == state.from_signals(frame).dtypes
        assert as_set(exact) == as_set(state.from_signals(frame))


def test_states_from_exact_parts(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path))
    frame = signals(spark, *({"id": k, "freight_cost": 0.1 * k} for k in range(20)))
    for number, half in enumerate((frame.where("id < 7"), frame.where("id >= 7"))):
        for family in families(EXACT_STATES):
            family_parts(store, family).add(number, rollup(half, family.values()))
    found = states_from_parts(store, EXACT_STATES)
    for name in SILVER:
        assert as_set(found[name]) == as_set(EXACT_STATES[name].from_signals(frame))
