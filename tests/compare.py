"""Exact comparison of a Spark result with the answer of DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples, columns by name, doubles by their exact text."""
    return sorted(in_order(frame))


def in_order(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    texts = [[_text(v) for v in frame[c].tolist()] for c in frame.columns]
    return list(zip(*texts, strict=True))


def assert_same_order(result: DataFrame, expected: pd.DataFrame) -> None:
    assert in_order(result.toPandas()) == in_order(expected)


def _text(value: object) -> str:
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return "<null>"
    return repr(value) if isinstance(value, float) else str(value)


def assert_same(result: DataFrame, expected: pd.DataFrame) -> None:
    found = result.toPandas()
    assert sorted(found.columns) == sorted(expected.columns)
    left, right = canonical(found), canonical(expected)
    assert len(left) == len(right)
    differing = [(a, b) for a, b in zip(left, right, strict=True) if a != b]
    assert not differing, f"{len(differing)} rows differ, first: {differing[0]}"
