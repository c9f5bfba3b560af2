"""Landing, streaming and full updates."""

from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from rows import as_set, signals

from depotlens.operators.quality import expect_or_drop
from depotlens.operators.measures import families, rollup
from depotlens.operators.states import STATES
from depotlens.plans.graph import build_all, parts_name, states_from_parts, update, update_states
from depotlens.plans.registry import QUERIES
from depotlens.schema import BRONZE, GOLD, SIGNALS, SILVER, SOURCE, signal_schema
from depotlens.sources.signals import append_batch, conform_signals, replay_batch, signals_from, stamp_batch
from depotlens.sources.store import CatalogStore, FolderStore, on_one_machine, shared_folder, working_scope, working_store
from depotlens.streaming.ingest import ingest


@pytest.fixture
def run(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path / "tables"))

    def go(**options):
        return ingest(store, str(tmp_path / "progress"), **options)

    return store, go


def bronze(store):
    return store.read(BRONZE[0])


def test_each_run_reads_only_what_landed_since(spark, run):
    store, go = run
    append_batch(signals(spark, {"id": 1}, {"id": 2, "source_system": None}), store)
    first = go()
    assert (first.input_rows, first.counters["valid_source_system_failed"]) == (2, 1)
    append_batch(signals(spark, {"id": 3}), store)
    second = go()
    assert (second.input_rows, second.counters["valid_source_system_passed"]) == (1, 1)
    third = go()
    assert (third.batches, third.input_rows) == (0, 0)
    assert sorted(r.id for r in bronze(store).collect()) == [1, 3]


def test_removed_landing_files_do_no_harm(spark, run):
    store, go = run
    append_batch(signals(spark, {"id": 1}), store)
    go()
    landing = store.path(SOURCE)
    for name in os.listdir(landing):
        if name.endswith(".parquet"):
            os.remove(os.path.join(landing, name))
    append_batch(signals(spark, {"id": 2}), store)
    go()
    assert sorted(r.id for r in bronze(store).collect()) == [1, 2]


def test_many_small_batches_are_all_counted(spark, run):
    store, go = run
    for n in range(6):
        append_batch(signals(spark, {"id": n}, {"id": n, "source_system": None}), store)
    report = go(max_bytes_per_batch=1)
    assert report.batches > 1
    assert report.counters == {"valid_source_system_passed": 6, "valid_source_system_failed": 6}
    assert bronze(store).count() == 6


def test_stream_equals_batch(spark, data, run):
    store, go = run
    frame = signals_from(spark, data)
    append_batch(frame, store)
    go(schema=signal_schema(T.TimestampNTZType()))
    assert as_set(bronze(store)) == as_set(expect_or_drop(frame))


@pytest.mark.parametrize("kind", ["folder", "catalog"])
def test_update_builds_every_table(spark, data, tmp_path, kind):
    folder, catalog = FolderStore(spark, str(tmp_path / "tables")), CatalogStore(spark, "updated")
    store = folder if kind == "folder" else catalog
    frame = signals_from(spark, data)
    as_of = F.lit("2024-01-01").cast("timestamp_ntz")
    early = F.col("signal_timestamp") < "1996-01-01"
    for part in (frame.where(early), frame.where(~early)):
        append_batch(part, store)
        report, _ = update(store, str(tmp_path / "progress"), frame.schema, as_of=as_of)
        assert report.input_rows == part.count()
    expected = build_all(frame, as_of=as_of)
    assert list(expected) == [*BRONZE, *SILVER, *GOLD]
    for name, plan in expected.items():
        assert store.read(name).columns == plan.columns
        assert as_set(store.read(name)) == as_set(plan), name


def test_states_are_updated_from_new_signals_only(spark, data, tmp_path):
    store = FolderStore(spark, str(tmp_path / "tables"))
    parts = FolderStore(spark, str(tmp_path / "parts"))
    frame = signals_from(spark, data, wide=True)
    as_of = F.lit("2024-01-01").cast("timestamp_ntz")
    early = F.col("signal_timestamp") < "1996-01-01"
    for part in (frame.where(early), frame.where(~early)):
        append_batch(part, store)
        landed, rolled, tables = update_states(store, str(tmp_path / "progress"), parts, frame.schema, as_of=as_of)
        assert landed.input_rows == part.count()
        # each family of states reads the new rows once
        assert rolled.input_rows == len(families(STATES)) * expect_or_drop(part).count()
    expected = build_all(frame, as_of=as_of)
    for name in (*SILVER, *GOLD):
        assert as_set(tables[name]) == as_set(expected[name]), name
    again = update_states(store, str(tmp_path / "progress"), parts, frame.schema, as_of=as_of)
    assert (again[0].input_rows, again[1].input_rows) == (0, 0)
    assert not any(name.endswith("_parts") for name in os.listdir(tmp_path / "tables"))


def test_a_repeated_batch_counts_once(spark, tmp_path):
    parts = FolderStore(spark, str(tmp_path / "parts"))
    batch = signals(spark, {"id": 1}, {"id": 2, "retail_location_id": "L2"})
    for _ in range(2):
        for family in families(STATES):
            parts.write(f"{parts_name(family)}/batch=0", rollup(batch, family.values()))
    row = states_from_parts(parts)[SILVER[2]].first()
    assert (row.served_location_count, row.route_cost_exposure) == (2, 100.0)


def test_working_folders_are_dropped(spark, data):
    folder = shared_folder(spark)
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    with working_scope():
        QUERIES["materialized_decisions"](spark, data).count()
        assert set(os.listdir(folder)) > before
    assert set(os.listdir(folder)) == before


def test_conformed_signals_have_the_signal_schema(spark, data):
    found = signals_from(spark, data)
    kinds = signal_schema(T.TimestampNTZType())
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in kinds]
    assert len(SIGNALS) == 20


def test_no_line_is_lost(spark, data):
    lines = spark.read.parquet(f"{data}/lineitem.parquet").count()
    assert signals_from(spark, data).count() == lines


def test_stamped_batch(spark):
    moment = datetime(2024, 5, 1, 3, 4, 5)
    row = stamp_batch(signals(spark, {"id": 42}), " demo ", moment).first()
    assert row.ingest_batch_id == "BATCH-demo-20240501030405"
    assert row.source_record_id == "SRC-demo-42"
    assert row.record_created_ts == moment
    assert row.id % 100_000 == 42


def test_replayed_batch(spark):
    moment = datetime(2024, 5, 1, 3, 4, 5)
    rows = replay_batch(signals(spark, {"id": 0}, {"id": 5}, {"id": 24}, {"id": None}), moment, 24).collect()
    assert {r.id: r.signal_timestamp for r in rows} == {0: moment, 5: datetime(2024, 4, 30, 22, 4, 5), 24: moment, None: None}
    with pytest.raises(ValueError, match="hours"):
        replay_batch(signals(spark, {}), moment, 0)


@pytest.mark.parametrize("tag", ["", "  "])
def test_blank_batch_tag_is_refused(spark, data, tag):
    with pytest.raises(ValueError, match="batch_tag"):
        signals_from(spark, data, tag)
    with pytest.raises(ValueError, match="batch_tag"):
        stamp_batch(signals(spark, {}), tag, datetime(2024, 1, 1))


def test_orders_with_many_lines_stay_whole(spark):
    """One order with a third of all lines."""
    lines = spark.range(3000).select(
        F.when(F.col("id") < 1000, 1).otherwise(F.col("id")).cast("long").alias("l_orderkey"),
        F.col("id").alias("l_partkey"),
        F.col("id").alias("l_suppkey"),
        (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        F.lit(2.0).alias("l_quantity"),
        F.lit("R").alias("l_returnflag"),
        F.lit("1995-01-01").cast("timestamp_ntz").alias("l_shipdate"),
    )
    orders = spark.range(1, 3000).select(
        F.col("id").alias("o_orderkey"),
        (F.col("id") % 5).alias("o_custkey"),
        F.lit("1995-01-01").cast("timestamp_ntz").alias("o_orderdate"),
    )
    customer = spark.range(5).select(
        F.col("id").alias("c_custkey"), F.col("id").cast("int").alias("c_nationkey")
    )
    assert conform_signals(lines, orders, customer).count() == 3000


def test_catalog_store_uses_the_session_namespace(spark):
    assert CatalogStore.from_session(spark).namespace == "operations"
    spark.conf.set("depotlens.namespace", "other_ops")
    try:
        store = CatalogStore.from_session(spark)
    finally:
        spark.conf.unset("depotlens.namespace")
    written = store.write("numbers", spark.range(3))
    assert written.count() == 3
    store.write("numbers", spark.range(2))
    assert spark.table("other_ops.numbers").count() == 2


def test_a_cluster_needs_a_shared_folder(spark):
    assert [on_one_machine(m) for m in ("local", "local[8]", "local-cluster[3,2,1000]", "yarn", "k8s://x")] == [True, True, False, False, False]

    class Cluster:
        sparkContext = type("Context", (), {"master": "yarn"})  # noqa: N815
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster())


def test_working_store_lies_in_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    assert working_store(spark).root.startswith(folder)
