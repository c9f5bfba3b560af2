"""Row expectations: keep the rows that meet them and count the others."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Fixed value: the expectation every signal has to meet.
SIGNAL_EXPECTATIONS = {"valid_source_system": "source_system IS NOT NULL"}


def _met(predicate: str) -> Column:
    return F.coalesce(F.expr(predicate), F.lit(False))


def _counters(expectations: Mapping[str, str]) -> list[Column]:
    counters = []
    for name, predicate in expectations.items():
        counters.append(F.count_if(_met(predicate)).alias(f"{name}_passed"))
        counters.append(F.count_if(~_met(predicate)).alias(f"{name}_failed"))
    return counters


def expect_or_drop(
    frame: DataFrame,
    expectations: Mapping[str, str] = SIGNAL_EXPECTATIONS,
    observation: Observation | str | None = None,
) -> DataFrame:
    """Drop rows that break any expectation; an unknown outcome counts as broken.

    With an ``observation`` (an object in batch, a name in a stream) the passed
    and failed rows are counted by the very job that consumes the result."""
    if observation is not None:
        frame = frame.observe(observation, *_counters(expectations))
    for predicate in expectations.values():
        frame = frame.where(_met(predicate))
    return frame


def expectation_counts(
    frame: DataFrame, expectations: Mapping[str, str] = SIGNAL_EXPECTATIONS
) -> DataFrame:
    """One row per expectation, read from just the columns it mentions."""
    totals = frame.agg(*_counters(expectations))
    rows = ", ".join(f"'{n}', `{n}_passed`, `{n}_failed`" for n in expectations)
    return totals.selectExpr(
        f"stack({len(expectations)}, {rows}) AS (expectation, passed, failed)"
    )
