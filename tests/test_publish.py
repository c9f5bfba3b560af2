"""Publishing to a folder, reconciliation, and the JDBC settings."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T
from rows import as_set, frame

from depotlens.plans import publish
from depotlens.plans.graph import materialize
from depotlens.schema import GOLD, KEYS
from depotlens.sources.signals import signals_from
from depotlens.sources.store import FolderStore

SCHEMA = "market_key string, product_id string, units int"
KEY = ("market_key", "product_id")


@pytest.fixture
def target(spark, tmp_path):
    return publish.FolderTarget(FolderStore(spark, str(tmp_path / "serving")))


@pytest.fixture(scope="module")
def gold(spark, data, tmp_path_factory):
    store = FolderStore(spark, str(tmp_path_factory.mktemp("gold")))
    return materialize(signals_from(spark, data).where("source_system IS NOT NULL"), store)


def test_publish_all_twice(spark, gold, target):
    for _ in range(2):
        assert publish.publish(gold, target) == list(GOLD)
    for name in GOLD:
        row = publish.reconcile(name, gold[name], target, KEYS[name]).first()
        assert row.ok and row.source_rows == gold[name].count()


class Tampered(publish.FolderTarget):
    """A target that stores something else than it was given."""

    change = None

    def replace(self, name, frame):
        super().replace(name, type(self).change(frame))


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (lambda f: f.where("units > 1"), "3 rows in the source, 2 published"),
        (
            lambda f: f.selectExpr("market_key", "'P1' AS product_id", "units"),
            "3 keys in the source, 2 published",
        ),
    ],
)
def test_differences_raise_and_stop(spark, target, change, message):
    class Broken(Tampered):
        pass

    Broken.change = staticmethod(change)
    source = frame(spark, SCHEMA, ("M", "P1", 1), ("M", "P2", 2), (None, "P1", 3))
    tables = {"first": source, "second": source}
    broken = Broken(target.store)
    with pytest.raises(publish.ReconciliationError, match=f"first: {message}"):
        publish.publish(tables, broken, order=("first", "second"), keys={"first": KEY})
    assert target.store.read("first").count() > 0
    with pytest.raises(Exception, match="second"):
        target.store.read("second").count()


def test_null_counts_as_a_key_value(spark):
    rows = frame(spark, SCHEMA, ("M", None, 1), ("M", None, 2), (None, None, 3), ("M", "P", 4))
    assert tuple(publish.counts(rows, KEY).first()) == (4, 3)
    assert tuple(publish.counts(rows.limit(0), KEY).first()) == (0, 0)
    assert tuple(publish.counts(rows, ()).first()) == (4, 0)


def test_table_without_columns_is_skipped(spark, target, caplog):
    empty = spark.createDataFrame([], T.StructType([]))
    assert publish.publish({"bare": empty}, target, order=("bare",)) == []
    assert "bare" in caplog.text


@pytest.mark.parametrize(
    ("kind", "expected"),
    [
        (T.ByteType(), "BIGINT"), (T.ShortType(), "BIGINT"), (T.IntegerType(), "BIGINT"),
        (T.LongType(), "BIGINT"), (T.FloatType(), "DOUBLE PRECISION"),
        (T.DoubleType(), "DOUBLE PRECISION"), (T.DecimalType(12, 2), "DOUBLE PRECISION"),
        (T.BooleanType(), "BOOLEAN"), (T.TimestampType(), "TIMESTAMPTZ"),
        (T.TimestampNTZType(), "TIMESTAMPTZ"), (T.DateType(), "DATE"), (T.StringType(), "TEXT"),
        (T.DayTimeIntervalType(), "TEXT"),
    ],
)
def test_serving_types(kind, expected):
    assert publish.serving_type(kind) == expected


@pytest.mark.parametrize("kind", ["array<int>", "map<string,int>", "struct<a:int>"])
def test_nested_types_are_refused(spark, kind):
    nested = spark.createDataFrame([], f"a {kind}")
    with pytest.raises(TypeError, match="no serving type"):
        publish.serving_columns(nested)


def test_serving_columns_are_cast(spark):
    row = "int1 int, real1 float, money decimal(9,2), flag boolean, day date, text string"
    found = publish.serving_columns(spark.createDataFrame([], row))
    assert [k for _, k in found.dtypes] == ["bigint", "double", "double", "boolean", "date", "string"]
    described = publish.describe_columns(spark.createDataFrame([], "a int, b string").schema)
    assert described == [(1, "a", "int", "BIGINT"), (2, "b", "string", "TEXT")]


def test_serving_copy_keeps_values(spark, gold, target):
    name = GOLD[2]
    publish.publish(gold, target, order=(name,))
    copied = target.store.read(name)
    assert dict(copied.dtypes)["forecast_horizon_days"] == "bigint"
    assert as_set(copied) == as_set(gold[name])


def test_times_without_zone_do_not_depend_on_the_session(spark):
    rows = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' AS t, TIMESTAMP_NTZ'2024-07-01 12:00:00' AS `a.b`")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session)
            for zone, moved in (("UTC", 0), ("Europe/Berlin", 3600)):
                sent = publish.serving_columns(rows, zone).selectExpr("unix_seconds(t)", "unix_seconds(`a.b`)").first()
                assert tuple(sent) == (1704067200 - moved, 1719835200 - 2 * moved)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


class Recorded(publish.JdbcTarget):
    """A target that keeps its statements instead of running them."""

    lost = 0

    def execute(self, statements):
        self.properties["log"].append(list(statements))

    def fill(self, name, frame):
        self.properties["log"].append(frame.count())

    def counts(self, name, keys):
        rows = self.properties["log"][-1] - self.lost
        return self.spark.createDataFrame([(rows, 0)], "row_count bigint, key_count bigint")


def test_jdbc_statements(spark):
    log = []
    target = Recorded(spark, "jdbc:postgresql://host/db", 'ser"ving', {"log": log}, batch_rows=500)
    rows = spark.createDataFrame([(1, 2.0, "x"), (2, None, None)], "`group` bigint, `t; x` double, s string")
    target.replace("t", rows)
    columns = '("group" BIGINT, "t; x" DOUBLE PRECISION, "s" TEXT)'
    assert log == [
        [
            'CREATE SCHEMA IF NOT EXISTS "ser""ving"',
            'DROP TABLE IF EXISTS "ser""ving"."t__staging"',
            f'CREATE TABLE IF NOT EXISTS "ser""ving"."t__staging" {columns}',
        ],
        2,
        [
            f'CREATE TABLE IF NOT EXISTS "ser""ving"."t" {columns}',
            'TRUNCATE TABLE "ser""ving"."t"',
            'INSERT INTO "ser""ving"."t" ("group", "t; x", "s") SELECT "group", "t; x", "s" FROM "ser""ving"."t__staging"',
            'DROP TABLE "ser""ving"."t__staging"',
        ],
    ]
    query = target.count_query("t", ("group", "t; x"))
    assert query.endswith('FROM "ser""ving"."t" GROUP BY "group", "t; x") key_rows')
    options = target.write_options("t")
    assert options["dbtable"] == '"ser""ving"."t__staging"' and options["batchsize"] == "500"
    with pytest.raises(ValueError, match="url"):
        publish.JdbcTarget(spark, " ")


def test_jdbc_swaps_only_what_is_whole(spark):
    class Lossy(Recorded):
        lost = 1

    log = []
    with pytest.raises(publish.ReconciliationError, match="t: 3 rows sent, 2 staged"):
        Lossy(spark, "jdbc:x", properties={"log": log}).replace("t", spark.range(3))
    assert len(log) == 2
