"""Landing tables followed by their commits."""

from __future__ import annotations

import os
import threading

import pytest
from pyspark.sql import functions as F
from rows import signals

from depotlens.sources import landing as module
from depotlens.sources.landing import LandingTable
from depotlens.streaming.ingest import ingest_commits


def batch(spark, name, *ids, **more):
    return signals(spark, *({"id": i, "ingest_batch_id": name, **more} for i in ids))


def ids(frame):
    return sorted(r.id for r in frame.collect())


@pytest.fixture
def tables(spark, tmp_path):
    landing = LandingTable(spark, str(tmp_path / "landing"))
    bronze = LandingTable(spark, str(tmp_path / "bronze"))
    return landing, bronze, lambda **options: ingest_commits(landing, bronze, str(tmp_path / "progress"), **options)


def test_rewritten_files_are_no_new_data(spark, tables):
    landing, bronze, go = tables
    landing.land(batch(spark, "a", 1, 2))
    assert go().input_rows == 2
    landing.land(batch(spark, "b", 3))
    before = {f for f in os.listdir(landing.path("data"))}
    assert landing.rewrite() == 3
    assert landing.drop_rewritten() == 2
    assert not before & set(os.listdir(landing.path("data")))
    # b was rewritten before it was streamed; a is not read again
    report = go()
    assert (report.batches, report.input_rows) == (1, 1)
    landing.land(batch(spark, "c", 4))
    landing.rewrite()
    landing.rewrite()
    landing.drop_rewritten()
    assert go().input_rows == 1
    assert go().batches == 0
    assert ids(bronze.read()) == ids(landing.read()) == [1, 2, 3, 4]


def test_expectations_are_counted(spark, tables):
    landing, bronze, go = tables
    landing.land(signals(spark, {"id": 1}, {"id": 2, "source_system": None}))
    report = go()
    assert report.counters == {"valid_source_system_passed": 1, "valid_source_system_failed": 1}
    assert ids(bronze.read()) == [1]


def test_a_batch_lands_once(spark, tables):
    landing, _, _ = tables
    assert landing.land(batch(spark, "a", 1, 2)).row_count == 2
    assert landing.land(batch(spark, "a", 1, 2)) is None
    both = batch(spark, "a", 1, 2).unionAll(batch(spark, "b", 3))
    assert landing.land(both).row_count == 1
    assert landing.land(batch(spark, None, 8)).row_count == 1
    assert landing.land(batch(spark, None, 8)).row_count == 1  # without a batch always
    assert ids(landing.read()) == [1, 2, 3, 8, 8]
    entries = {(r.batch_id, r.row_count, r.commit) for r in landing.ledger().collect()}
    assert entries == {("a", 2, 1), ("b", 1, 2), (None, 1, 3), (None, 1, 4)}


def test_the_ledger_outlives_rewrites(spark, tables):
    landing, _, _ = tables
    landing.land(batch(spark, "a", 1))
    landing.rewrite()
    landing.drop_rewritten()
    assert landing.land(batch(spark, "a", 1)) is None


def test_a_lost_landing_leaves_nothing(spark, tables, monkeypatch):
    """Killed after its files are written and before its commit, a landing is not seen,
    and is done as a whole when it is repeated."""
    landing, bronze, go = tables

    def killed(self, number, **entry):
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(LandingTable, "_commit", killed)
        with pytest.raises(RuntimeError, match="killed"):
            landing.land(batch(spark, "a", 1, 2))
    assert os.listdir(landing.path("data")) and landing.read().count() == 0
    assert go().batches == 0
    assert landing.land(batch(spark, "a", 1, 2)).row_count == 2
    go()
    assert ids(bronze.read()) == [1, 2]


def test_a_lost_stream_step_is_repeated_once(spark, tables, monkeypatch):
    """A step that ended in bronze but not in the checkpoint comes again."""
    landing, bronze, go = tables
    landing.land(batch(spark, "a", 1))
    plain = LandingTable.land

    def lands_then_dies(self, *arguments, **options):
        plain(self, *arguments, **options)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(LandingTable, "land", lands_then_dies)
        with pytest.raises(Exception, match="driver lost"):
            go()
    plain(landing, batch(spark, "b", 2))
    go()
    assert ids(bronze.read()) == [1, 2]


def test_a_lost_checkpoint_loads_nothing_twice(spark, tables, tmp_path):
    landing, bronze, go = tables
    landing.land(batch(spark, "a", 1))
    go()
    landing.land(batch(spark, "b", 2))
    ingest_commits(landing, bronze, str(tmp_path / "another"))
    assert ids(bronze.read()) == [1, 2]


def test_named_sources_land_once(spark, tables):
    landing, _, _ = tables
    assert not landing.land(batch(spark, "a", 1), sources=["x", "y"]).repeated
    assert landing.land(batch(spark, "a", 1), sources=["y", "x"]).repeated
    with pytest.raises(ValueError, match="1 of the 2 sources"):
        landing.land(batch(spark, "a", 1), sources=["y", "z"])
    assert landing.land(batch(spark, "a", 2).where("false"), sources=["z"]).row_count == 0
    assert ids(landing.read()) == [1]


def test_many_commits_in_small_steps(spark, tables):
    landing, bronze, go = tables
    for k in range(5):
        landing.land(batch(spark, f"b{k}", k), even_files=False)
    assert go(max_commits_per_batch=2).batches == 3
    assert ids(bronze.read()) == [0, 1, 2, 3, 4]


def test_writers_that_meet_start_over(spark, tables):
    """Of two writers of one batch that look at the log at the same time, one lands."""
    landing, _, _ = tables
    landing.create()
    meet, plain, results = threading.Barrier(2), LandingTable._without_landed, []

    def both_have_looked(self, rows, before):
        fresh = plain(self, rows, before)
        if before == 0:
            meet.wait(60)
        return fresh

    rows = batch(spark, "a", 1, 2)
    module.LandingTable._without_landed = both_have_looked
    try:
        writers = [threading.Thread(target=lambda: results.append(landing.land(rows))) for _ in range(2)]
        for writer in writers:
            writer.start()
        for writer in writers:
            writer.join()
    finally:
        module.LandingTable._without_landed = plain
    assert sorted(r.row_count if r else 0 for r in results) == [0, 2]
    assert ids(landing.read()) == [1, 2]
    assert sorted(os.listdir(landing.path("data"))) == sorted(r.landing for r in landing.log().collect())


def test_a_hot_batch_and_the_plan_of_landing(spark, tables):
    """What has landed is left out by a join on the batch, without collecting any."""
    landing, _, _ = tables
    landing.land(batch(spark, "a", *range(50)))
    fresh = landing._without_landed(batch(spark, "a", *range(50)).unionAll(batch(spark, "b", 99)), 1)
    text = fresh._jdf.queryExecution().toString()
    assert "LeftAnti" in text and "CartesianProduct" not in text
    assert ids(fresh) == [99]


def test_empty_table(spark, tables):
    landing, _, go = tables
    landing.create()
    assert landing.read().count() == 0 and landing.rewrite() is None and landing.drop_rewritten() == 0
    assert landing.land(batch(spark, "a", 1).where(F.lit(False))) is None
    assert landing.log().count() == 0 and go().batches == 0
