"""Every registered query against its oracle text."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from compare import assert_same, assert_same_order, connect

import __spark_entry__ as contract

from depotlens.plans.oracle import ORACLE
from depotlens.plans.registry import QUERIES

# queries whose rows come in a defined order
ORDERED = (
    "raw_signals_by_source", "signals_by_source", "decision_summary", "decision_summary_wide",
    "report_inventory_health", "report_forecast_trend", "report_dispatch_risk", "top_forecasts",
    "ask_top_markets", "ask_route_risk",
)


@pytest.fixture(scope="module")
def duck(data):
    with connect(data) as connection:
        yield connection


def test_every_query_has_an_oracle_and_is_registered():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLE.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", ORDERED)
def test_rows_come_in_order(spark, duck, data, name):
    assert "ORDER BY" in ORACLE[name]
    expected = duck.execute(ORACLE[name]).df()
    assert_same_order(QUERIES[name](spark, data), expected)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, duck, data, name):
    expected = duck.execute(ORACLE[name]).df()
    assert len(expected) > 0
    assert_same(QUERIES[name](spark, data), expected)


# DuckDB's name of each Spark type that occurs in a result
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("reconcile")])
def test_query_has_the_types_of_its_oracle(spark, duck, data, name):
    expected = duck.sql(ORACLE[name])
    found = {column: TYPES[kind] for column, kind in QUERIES[name](spark, data).dtypes}
    assert found == dict(zip(expected.columns, map(str, expected.types), strict=True))


@pytest.mark.parametrize("hidden", ["zstandard", "tokenizers", "depotlens.llm", "corpus_pipeline"])
def test_queries_without_the_optional_packages(hidden):
    """The other queries stay where a package of the training-data operators is absent."""
    script = (
        f"import sys; sys.modules[{hidden!r}] = None\n"
        "import __spark_entry__ as entry; from depotlens.plans.registry import QUERIES\n"
        "assert entry.queries().keys() == entry.oracle_sql().keys() == QUERIES.keys()"
    )
    root = os.path.dirname(os.path.abspath(contract.__file__))
    done = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    if hidden in ("zstandard", "tokenizers") and os.path.exists(os.path.join(root, "corpus_pipeline.py")):
        assert hidden in done.stderr


def test_entry_runs(spark):
    frame = contract.entry(spark)
    assert len(frame.columns) == 28
    assert frame.count() > 0
