"""Enough tasks for groups or keys that grow with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame


def exceeds(frame: DataFrame, tasks: int) -> bool:
    """Whether ``tasks`` are more than a shuffle of the session has."""
    return tasks > int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dealt(frame: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """``frame`` dealt to ``tasks`` tasks by ``keys``, where a shuffle of the session has fewer
    (``spark.sql.shuffle.partitions``); otherwise ``frame``, whose shuffles adaptive
    execution plans. What a task holds then doesn't grow with the data."""
    return frame.repartition(tasks, *keys) if exceeds(frame, tasks) else frame
