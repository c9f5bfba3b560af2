"""Tables that are refreshed together."""

from __future__ import annotations

import os
import uuid
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from rows import as_set

from depotlens.operators.quality import expect_or_drop
from depotlens.plans.graph import build_all, materialize, refresh
from depotlens.schema import GOLD, SILVER
from depotlens.sources.signals import signals_from
from depotlens.sources.versions import Refresh, VersionedTables

TABLES = (*SILVER, *GOLD)


@pytest.fixture
def tables(spark, tmp_path):
    found = VersionedTables(spark, f"serving_{uuid.uuid4().hex}", str(tmp_path / "tables"))
    yield found
    spark.sql(f"DROP DATABASE IF EXISTS `{found.namespace}` CASCADE")


@pytest.fixture(scope="module")
def halves(spark, data, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bronze"))
    expect_or_drop(signals_from(spark, data)).write.mode("overwrite").parquet(path)
    whole = spark.read.parquet(path)
    return whole, whole.where(F.pmod("id", F.lit(2)) == 0)


AS_OF = "2024-01-01"


def clock():
    return F.lit(AS_OF).cast("timestamp_ntz")


@pytest.mark.parametrize("last", [4, len(TABLES)])
def test_a_refresh_that_dies_between_tables_changes_none(tables, halves, monkeypatch, last):
    whole, half = halves
    refresh(half, tables, as_of=clock())
    before = {name: as_set(tables.read(name)) for name in TABLES}
    version, plain, written = tables.current(), Refresh.write, []

    def dies(self, name, frame):
        if len(written) == last:
            raise RuntimeError("killed")
        written.append(name)
        return plain(self, name, frame)

    with monkeypatch.context() as patched:
        patched.setattr(Refresh, "write", dies)
        if last == len(TABLES):  # all are written, but the driver is lost before the swap
            patched.setattr(VersionedTables, "publish", lambda *_: dies(None, "", None))
        with pytest.raises(RuntimeError, match="killed"):
            refresh(whole, tables, as_of=clock())
    assert len(written) == last
    assert tables.current() == version
    for name in TABLES:
        assert as_set(tables.read(name)) == before[name], name
    refresh(whole, tables, as_of=clock())
    expected = build_all(whole, as_of=clock())
    for name in TABLES:
        assert as_set(tables.read(name)) == as_set(expected[name]), name


def test_one_statement_swaps_all_tables(spark, tables, monkeypatch):
    def publish(n):
        attempt = tables.begin()
        for name in ("a", "b"):
            attempt.write(name, spark.range(n))
        return attempt

    tables.publish(publish(1))
    attempt, said, plain = publish(2), [], spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: said.append(text) or plain(text, *a, **k))
    tables.publish(attempt)
    changing = [text for text in said if text.startswith("CREATE") and "DATABASE" not in text]
    assert changing == [f"CREATE OR REPLACE VIEW `{tables.namespace}`.`current_version` AS SELECT '{attempt.version}' AS version"]
    assert tables.read("a").count() == tables.read("b").count() == 2


def test_readers_prune_to_the_current_version(spark, tables):
    for n in (5, 7):
        attempt = tables.begin()
        attempt.write("a", spark.range(n))
        tables.publish(attempt)
    frame = tables.read("a")
    assert frame.count() == 7 and frame.columns == ["id"]
    text = frame._jdf.queryExecution().toString()
    assert "PartitionFilters" in text and "version" in text.split("PartitionFilters")[1].split("]")[0]


def test_old_versions_go_after_their_time(spark, tables):
    start = datetime(2024, 5, 1, tzinfo=timezone.utc)
    frames = {}
    for hour in (0, 1, 2):
        attempt = tables.begin(start + timedelta(hours=hour))
        attempt.write("a", spark.range(hour + 1))
        tables.publish(attempt)
        frames[hour] = tables.read("a")
    failed = tables.begin(start)
    failed.write("a", spark.range(99))
    dropped = tables.expire(timedelta(hours=1.5), start + timedelta(hours=2))
    assert len(dropped) == 2 and f"a/{failed.version}" in dropped
    left = [f for f in os.listdir(tables.path("a")) if f.startswith("version=")]
    assert len(left) == 2
    assert tables.read("a").count() == 3
    tables.expire(timedelta(0), start + timedelta(days=9))
    assert [f for f in os.listdir(tables.path("a")) if f.startswith("version=")] == [f"version={tables.current()}"]


def test_a_refresh_must_be_whole(spark, tables):
    attempt = tables.begin()
    for name in ("a", "b"):
        attempt.write(name, spark.range(1))
    tables.publish(attempt)
    part = tables.begin()
    part.write("a", spark.range(2))
    with pytest.raises(ValueError, match="lacks b"):
        tables.publish(part)
    part.write("b", spark.range(2).withColumn("more", F.lit(1)))
    with pytest.raises(ValueError, match="b has other columns"):
        tables.publish(part)
    assert tables.read("a").count() == tables.read("b").count() == 1
    grown = tables.begin()
    for name in ("a", "b", "c"):
        grown.write(name, spark.range(3))
    tables.publish(grown)
    assert tables.names() == ["a", "b", "c"]
    assert [tables.read(name).count() for name in tables.names()] == [3, 3, 3]


def test_nothing_published(tables):
    assert tables.current() is None and tables.names() == []
    assert tables.expire(timedelta(0)) == []


def test_materialize_takes_a_refresh(tables, halves):
    attempt = tables.begin()
    written = materialize(halves[1], attempt, as_of=clock())
    assert set(written) == set(TABLES) == set(attempt.written)
    assert tables.current() is None
