"""Tables laid out for joins and for filters, and sets kept as bitmaps."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F
from rows import as_set, frame, signals

from depotlens.operators import serving
from depotlens.operators.measures import merged_parts, rollup
from depotlens.operators.states import DISPATCH
from depotlens.plans.graph import build_all
from depotlens.schema import GOLD, OFFER
from depotlens.sources.clustered import ClusteredTable, bounds, curve_position
from depotlens.sources.numbers import Numbers
from depotlens.sources.parts import Parts
from depotlens.sources.signals import signals_from
from depotlens.sources.store import CatalogStore, FolderStore


def plan(found):
    return found._jdf.queryExecution().executedPlan().toString()


def test_stored_offers_are_joined_where_they_lie(spark, data):
    tables = build_all(signals_from(spark, data))
    store = CatalogStore(spark, f"offers_{uuid.uuid4().hex}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in (GOLD[1], GOLD[2]):
            store.write_bucketed(name, tables[name], OFFER, 4)
        joined = serving.forecast_positions(store.read(GOLD[1]), store.read(GOLD[2]))
        text = plan(joined)
        assert "SortMergeJoin" in text and "Exchange" not in text
        grouped = store.read(GOLD[1]).groupBy(*OFFER).agg(F.count("*").alias("n"))
        assert "Exchange" not in plan(grouped)
        assert as_set(joined) == as_set(serving.forecast_positions(tables[GOLD[1]], tables[GOLD[2]]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP DATABASE `{store.namespace}` CASCADE")


@pytest.fixture(scope="module")
def cube(spark, tmp_path_factory):
    rows = spark.range(16 * 16 * 16).select(
        *[F.concat(F.lit(c), F.lpad((F.shiftright("id", 4 * k) % 16).cast("string"), 2, "0")).alias(c) for k, c in enumerate("xyz")],
        "id",
    )
    table = ClusteredTable(spark, str(tmp_path_factory.mktemp("cube")), ("x", "y", "z"), files=64)
    table.write(rows)
    return rows, table


@pytest.mark.parametrize("column", ["x", "y", "z"])
def test_any_column_meets_few_files(cube, column):
    rows, table = cube
    for value in (f"{column}00", f"{column}07", f"{column}15"):
        # a cube cut into 64 boxes: a plane meets a quarter of them
        assert len(table.files_with(**{column: value})) == 16
        assert as_set(table.read(**{column: value})) == as_set(rows.where(F.col(column) == value))


def test_several_columns_meet_fewer(cube):
    rows, table = cube
    assert len(table.files_with()) == 64 and len(table.files_with(x="x03", y="y03")) == 4
    assert table.read(x="x03", y="y03", z="z03").count() == 1
    assert table.read(x="nowhere").count() == 0 and table.files_with(x="a") == []
    assert table.read().count() == rows.count()
    with pytest.raises(ValueError, match="id is none of"):
        table.files_with(id=3)


def test_nulls_hot_values_and_no_rows(spark, tmp_path):
    table = ClusteredTable(spark, str(tmp_path / "t"), ("a", "b"), files=4)
    rows = [("hot", k % 5, k) for k in range(300)] + [(None, 1, 0), ("x", None, 1), ("y", 2, 2)]
    given = frame(spark, "a string, b int, n int", *rows)
    table.write(given)
    assert as_set(table.read(a=None)) == as_set(given.where("a is null"))
    assert as_set(table.read(b=None)) == as_set(given.where("b is null"))
    assert table.read(a="hot").count() == 300 and table.read(a="x", b=None).count() == 1
    sizes = [r["count"] for r in table.read().groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 250  # the hot value is cut
    empty = ClusteredTable(spark, str(tmp_path / "e"), ("a", "b"), files=4)
    empty.write(given.where("false"))
    assert empty.read().count() == 0 and empty.read(a="x").count() == 0


def test_places_on_the_curve(spark):
    rows = frame(spark, "a int, b int", *[(a, b) for a in range(4) for b in range(4)])
    cuts = bounds(rows, ("a", "b"), bits=2)
    assert cuts == {"a": [1, 2, 3], "b": [1, 2, 3]}
    found = {(r.a, r.b): r.place for r in rows.withColumn("place", curve_position(cuts, 2)).collect()}
    for (a, b), place in found.items():
        assert place == sum((a >> k & 1) << 2 * k + 1 | (b >> k & 1) << 2 * k for k in range(2))


# bitmaps


def test_numbers_last_and_a_batch_may_come_again(spark, tmp_path):
    numbers = Numbers(FolderStore(spark, str(tmp_path)), "v")
    batches = [["a", "b", None, "a"], ["b", "c"], ["c", "d", "a"]]
    for _ in range(2):
        for k, values in enumerate(batches):
            numbers.add(k, frame(spark, "v string", *[(v,) for v in values]))
    found = {r.v: r.number for r in numbers.read().collect()}
    assert sorted(found) == ["a", "b", "c", "d"] and len(set(found.values())) == 4
    rows = numbers.numbered(3, frame(spark, "v string, n int", ("d", 1), (None, 2), ("e", 3), ("a", 4))).collect()
    assert {r.n: r.v__number for r in rows if r.n in (1, 2, 4)} == {1: found["d"], 2: None, 4: found["a"]}
    with pytest.raises(ValueError, match="batch -1"):
        numbers.add(-1, frame(spark, "v string", ("x",)))


def test_bitmaps_count_the_same_and_keep_fewer_rows(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path))
    state = DISPATCH.by_bitmaps()
    parts = Parts(store, "lanes", lambda rolled: merged_parts(rolled, [state]), fan_in=2)
    numbers = Numbers(store, "retail_location_id")
    rows = [{"id": k, "route_id": f"R{k % 2}", "retail_location_id": f"L{k * 7 % 90}" if k % 10 else None} for k in range(400)]
    rows.append({"route_id": "alone", "retail_location_id": None})
    whole = signals(spark, *rows)
    for n in range(3):
        parts.add(n, rollup(numbers.numbered(n, whole.where(F.col("id") % 3 == n)), [state]))
    merged = merged_parts(parts.read(), [state])
    assert as_set(state.from_rollup(merged)) == as_set(DISPATCH.from_signals(whole))
    plain = rollup(whole, [DISPATCH]).count()
    assert merged.count() <= 3 * (1 + 3) < plain


def test_bitmaps_of_several_ranges(spark):
    """Numbers in different ranges of 32,768 are added up, those of one range are or-ed."""
    rows = spark.createDataFrame(
        [("R", "M", "T", 1.0, 0.5, n) for n in (0, 1, 1, 32768, 32769, 100_000, None)],
        "route_id string, market_key string, terminal_id string, freight_cost double, telematics_risk double,"
        " retail_location_id__number bigint",
    )
    state = DISPATCH.by_bitmaps()
    both = rollup(rows, [state]).unionAll(rollup(rows, [state]))
    found = state.from_rollup(merged_parts(both, [state])).first()
    assert found.served_location_count == 5 and found.freight_cost_avg == 1.0
