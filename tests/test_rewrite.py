"""What a rewrite and the stream of commits shuffle, and the files they make."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from rows import signals

from depotlens.sources import landing as module
from depotlens.sources.landing import LANDING, LandingTable
from depotlens.streaming.ingest import ingest_commits


class Shuffled:
    """Stages of jobs, by what they hand on: a job without a shuffle has one."""

    def __init__(self, spark, name):
        self.spark, self.name = spark, name

    def __enter__(self):
        self.spark.sparkContext.setJobGroup(self.name, "")
        return self

    def __exit__(self, *_):
        tracker = self.spark.sparkContext.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(self.name)]
        self.stages = [len(j.stageIds) for j in jobs]
        self.spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.fixture
def landing(spark, tmp_path):
    """Many small landings, one of them without rows, with nulls and repeats."""
    table = LandingTable(spark, str(tmp_path / "landing"))
    for k in range(5):
        rows = [{"id": i % 40, "ingest_batch_id": f"b{k}", "freight_cost": None if i % 3 else 1.0} for i in range(50)]
        table.land(signals(spark, *rows).repartition(6), even_files=False)
    table.land(signals(spark, {}).where("false"), sources=["none"])
    return table


def files(table, folder):
    return glob.glob(f"{table.path('data', folder)}/*.parquet")


def content(frame):
    return sorted(map(str, frame.collect()))


def test_a_rewrite_packs_small_files_without_a_shuffle(spark, landing):
    before = content(landing.read())
    with Shuffled(spark, "rewrite") as seen:
        landing.rewrite()
    assert seen.stages and max(seen.stages) == 1
    assert content(landing.read()) == before and len(before) == 250
    target = landing._last(module.REWRITE)["landing"]
    assert len(files(landing, target)) == 1
    held = pq.read_table(files(landing, target)[0], columns=[LANDING])[LANDING].to_pylist()
    assert len(set(held)) == 5


def test_a_rewrite_makes_as_many_files_as_the_bytes_need(spark, landing, monkeypatch):
    total = module.stored_bytes(spark, landing.path("data"))
    monkeypatch.setattr(module, "FILE_BYTES", total // 3)
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        landing.rewrite()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    found = [pq.read_metadata(f).num_rows for f in files(landing, landing._last(module.REWRITE)["landing"])]
    assert 2 <= len(found) <= 4 and sum(found) == 250 and max(found) < 200


def test_the_stream_of_commits_keeps_every_row_once(spark, landing, tmp_path):
    bronze = LandingTable(spark, str(tmp_path / "bronze"))
    landing.rewrite()
    landing.land(signals(spark, {"id": 99, "ingest_batch_id": "late"}, {"id": 98, "source_system": None}))
    landing.rewrite()
    landing.drop_rewritten()
    report = ingest_commits(landing, bronze, str(tmp_path / "progress"))
    assert report.input_rows == 252 and report.counters["valid_source_system_failed"] == 1
    assert content(bronze.read()) == content(landing.read().where(F.col("source_system").isNotNull()))
    assert ingest_commits(landing, bronze, str(tmp_path / "progress")).batches == 0
