"""Where copies of a table differ."""

from __future__ import annotations

import pytest
from rows import frame

from depotlens.plans.differences import check_equal, differences, differing_buckets, fingerprints
from depotlens.plans.publish import ReconciliationError, counts

SCHEMA = "k string, n int, v double"
ROWS = [("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, None), (None, 1, 4.0), ("c", 1, 5.0), ("c", 1, 5.0), ("c", 1, 6.0)]


def found(spark, source, target, buckets=64):
    here, there = (frame(spark, SCHEMA, *rows) if rows else spark.createDataFrame([], SCHEMA) for rows in (source, target))
    listed = differences(here, there, ("k", "n"), buckets)
    return {(r.k, r.n): (r.difference, r.source_only, r.target_only) for r in listed.collect()}


@pytest.mark.parametrize("buckets", [1, 3, 4096])
def test_every_kind(spark, buckets):
    drifted = [("a", 1, 1.5), ("b", 1, 0.0), (None, 2, 4.0), ("c", 1, 5.0), ("c", 1, 6.0), ("c", 1, 6.0), ("d", 1, 1.0)]
    assert found(spark, ROWS, drifted, buckets) == {
        ("a", 1): ("changed", 1, 1),
        ("a", 2): ("lost", 1, 0),
        ("b", 1): ("changed", 1, 1),  # a null became a value
        (None, 1): ("lost", 1, 0),
        (None, 2): ("added", 0, 1),
        ("c", 1): ("changed", 1, 1),  # the same rows, in other numbers
        ("d", 1): ("added", 0, 1),
    }


def test_equal_copies(spark):
    assert found(spark, ROWS, ROWS[::-1]) == {}
    assert found(spark, [], []) == {}
    assert set(found(spark, ROWS, []).values()) == {("lost", 1, 0), ("lost", 3, 0)}
    check_equal("t", frame(spark, SCHEMA, *ROWS), frame(spark, SCHEMA, *ROWS[::-1]).select("v", "n", "k"), ("k", "n"))


def test_an_exchanged_key_is_seen_where_counts_agree(spark):
    here, there = frame(spark, SCHEMA, *ROWS), frame(spark, SCHEMA, ("z", 1, 1.0), *ROWS[1:])
    assert counts(here, ("k", "n")).first() == counts(there, ("k", "n")).first()
    with pytest.raises(ReconciliationError, match=r"t: rows differ in \d buckets, first a/1 lost"):
        check_equal("t", here, there, ("k", "n"))


def test_only_differing_buckets_are_compared(spark):
    rows = [(f"k{i}", i, float(i)) for i in range(2000)]
    here, there = frame(spark, SCHEMA, *rows), frame(spark, SCHEMA, *rows[:-1])
    assert differing_buckets(here, there, ("k", "n"), 256).count() == 1
    assert fingerprints(here, ("k", "n"), 256).count() <= 256
    text = differences(here, there, ("k", "n"), 256)._jdf.queryExecution().toString()
    assert "LeftSemi" in text and "CartesianProduct" not in text


def test_other_columns_are_refused(spark):
    with pytest.raises(ValueError, match="different columns"):
        differences(frame(spark, SCHEMA, *ROWS), frame(spark, SCHEMA, *ROWS).drop("v"), ("k",))
