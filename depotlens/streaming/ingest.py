"""Append-only ingest of landed signals into bronze."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from depotlens.operators.quality import SIGNAL_EXPECTATIONS, expect_or_drop
from depotlens.schema import BRONZE, SIGNALS, SOURCE
from depotlens.sources.landing import APPEND, LandingTable
from depotlens.sources.store import Store

EXPECTATIONS = "expectations"


@dataclass(frozen=True)
class IngestReport:
    """What one run to the end of the landed data did."""

    batches: int
    input_rows: int
    counters: dict[str, int] = field(default_factory=dict)


def signal_stream(
    store: Store, schema: StructType = SIGNALS, max_bytes_per_batch: int | None = None
) -> DataFrame:
    """Signals as they are appended to the source table. Changes and deletions of
    older rows are not followed; ``max_bytes_per_batch`` bounds one micro-batch."""
    options: dict[str, object] = {"skipChangeCommits": "true"}
    if max_bytes_per_batch:
        options["maxBytesPerTrigger"] = max_bytes_per_batch
    return store.read_stream(SOURCE, schema, **options)


def ingest(
    store: Store,
    checkpoint: str,
    schema: StructType = SIGNALS,
    expectations: Mapping[str, str] = SIGNAL_EXPECTATIONS,
    max_bytes_per_batch: int | None = None,
) -> IngestReport:
    """Run the stream until all landed signals are in bronze, then stop.

    The checkpoint and the sink's own log make each file count exactly once, also
    after a lost driver; a second run only sees what landed since."""
    landed = signal_stream(store, schema, max_bytes_per_batch)
    writer = (
        expect_or_drop(landed, expectations, EXPECTATIONS)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return _follow(store.start(BRONZE[0], writer))


def follow_table(
    store: Store,
    name: str,
    checkpoint: str,
    schema: StructType,
    keep: Callable[[DataFrame, int], None],
    max_bytes_per_batch: int | None = None,
) -> IngestReport:
    """Hand what a table got since the last run to ``keep``, batch by batch. A batch may
    come again after a failure, with the same number and the same rows."""
    options = {"maxBytesPerTrigger": max_bytes_per_batch} if max_bytes_per_batch else {}
    writer = (
        store.read_stream(name, schema, **options)
        .writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return _follow(writer.start())


def ingest_commits(
    landing: LandingTable,
    bronze: LandingTable,
    checkpoint: str,
    expectations: Mapping[str, str] = SIGNAL_EXPECTATIONS,
    max_commits_per_batch: int = 100,
) -> IngestReport:
    """Like :func:`ingest`, but following the commits of a landing table: a rewrite of
    landed files is no new data, and landings may be rewritten before they are streamed.

    Each landing reaches bronze once, whatever is repeated: bronze records which landings
    its commits hold, in the commit itself. A lost checkpoint costs a look at the log. The
    tasks that read landed files write those of bronze, without a shuffle; its upkeep is
    :meth:`LandingTable.rewrite`."""
    done: list[tuple[int, dict[str, int]]] = []
    bronze.create()

    def keep(commits: DataFrame, number: int) -> None:
        appends = commits.where(F.col("operation") == APPEND).collect()  # at most max_commits_per_batch rows
        known = bronze.landed_sources([c["landing"] for c in appends])
        fresh = [c for c in appends if c["landing"] not in known]
        if not fresh:
            return
        counted = Observation()
        rows = expect_or_drop(landing.rows_of(fresh), expectations, counted)
        bronze.land(rows, sources=[c["landing"] for c in fresh], even_files=False)
        done.append((sum(c["row_count"] for c in fresh), dict(counted.get)))

    writer = (
        landing.create().commits(max_commits_per_batch)
        .writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    writer.start().awaitTermination()
    totals: dict[str, int] = {}
    for _, counters in done:
        for name, value in counters.items():
            totals[name] = totals.get(name, 0) + value
    return IngestReport(len(done), sum(rows for rows, _ in done), totals)


def _follow(query: StreamingQuery) -> IngestReport:
    """Wait for the end, adding up progress on the way: only the latest reports are kept."""
    batches: dict[int, tuple[int, dict[str, int]]] = {}
    finished = False
    while not finished:
        finished = query.awaitTermination(1)
        for progress in query.recentProgress:
            metrics = progress.observedMetrics.get(EXPECTATIONS)
            counters = metrics.asDict() if metrics else {}
            batches[progress.batchId] = (progress.numInputRows, counters)
    totals: dict[str, int] = {}
    for _, counters in batches.values():
        for name, value in counters.items():
            totals[name] = totals.get(name, 0) + value
    read = [rows for rows, _ in batches.values()]
    return IngestReport(sum(1 for rows in read if rows), sum(read), totals)
