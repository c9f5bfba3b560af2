"""The data dictionary covers every column and reaches the catalog."""

from __future__ import annotations

import pytest

from depotlens.plans import dictionary
from depotlens.plans.graph import build_all
from depotlens.schema import BRONZE, GOLD, SILVER
from depotlens.sources.signals import signals_from
from depotlens.sources.store import CatalogStore

# columns per silver and gold table, in build order
WIDTHS = (12, 8, 8, 14, 18, 13, 9, 8, 28)


@pytest.fixture(scope="module")
def schemas(spark, data):
    return {name: frame.schema for name, frame in build_all(signals_from(spark, data)).items()}


def test_every_column_is_described(spark, schemas):
    assert tuple(len(schemas[name]) for name in SILVER + GOLD) == WIDTHS
    found = dictionary.data_dictionary(spark, schemas)
    assert found.count() == sum(WIDTHS) + 20
    assert found.where("comment IS NULL").count() == 0
    assert dictionary.gaps(found, found).count() == 0
    assert set(dictionary.TABLE_TEXT) == {*BRONZE, *SILVER, *GOLD}
    used = {c for s in schemas.values() for c in s.names}
    assert used == set(dictionary.COLUMN_TEXT)
    assert all(c in schemas[t].names for t, c in dictionary.COLUMN_TEXT_IN)


def test_gaps_are_found_both_ways(spark, schemas):
    found = dictionary.data_dictionary(spark, {BRONZE[0]: schemas[BRONZE[0]]})
    lacking = found.where("column_name <> 'id'")
    assert [tuple(r) for r in dictionary.gaps(lacking, found).collect()] == [
        (BRONZE[0], "id", "not described")
    ]
    assert [r.gap for r in dictionary.gaps(found, lacking).collect()] == ["no such column"]


def test_comments_reach_the_catalog(spark, schemas):
    store = CatalogStore(spark, "described")
    for name in BRONZE + SILVER + GOLD:
        store.write(name, spark.createDataFrame([], schemas[name]))
    assert dictionary.apply_comments(store, BRONZE + SILVER + GOLD) == len(WIDTHS) + sum(WIDTHS)
    for name in SILVER + GOLD:
        columns = spark.catalog.listColumns(f"described.{name}")
        assert {c.name: c.description for c in columns} == {
            c: dictionary.column_text(name, c) for c in schemas[name].names
        }
        assert spark.catalog.getTable(f"described.{name}").description == dictionary.TABLE_TEXT[name]
    assert all(not c.description for c in spark.catalog.listColumns(f"described.{BRONZE[0]}"))


def test_comments_in_the_schema(spark, schemas):
    name = GOLD[0]
    frame = dictionary.with_comments(name, spark.createDataFrame([], schemas[name]))
    texts = {f.name: f.metadata["comment"] for f in frame.schema}
    assert texts == {c: dictionary.column_text(name, c) for c in schemas[name].names}
    CatalogStore(spark, "described").write("with_text", frame)
    columns = spark.catalog.listColumns("described.with_text")
    assert {c.name: c.description for c in columns} == texts
