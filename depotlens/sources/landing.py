"""A landing table that is followed by its commits, not by its files.

Rows land in folders of their own; a commit, one small JSON file under the next number, makes
a folder visible. Commit files are never changed, so Spark's file stream over them sees every
landing once, whatever happens to the data files. Landed files may be rewritten into others
(:meth:`LandingTable.rewrite`): that is a commit of another kind, which is no new data.

    <root>/commits/00000000000000000007.json
    <root>/data/<landing>/part-….parquet     rows, with the landing they came by
    <root>/ledger/<landing>/part-….parquet   batches of the landing, with their rows

A landing is idempotent in two ways. Its batches (``ingest_batch_id``) are entered in a ledger
that becomes visible with the same commit; rows of a batch that is in the ledger don't land
again. And a caller may name what the rows come from (``sources``), which lands once only: so a
repeated step of a stream does nothing. Writers that meet start over: a commit number is given once, by a rename that doesn't
replace, and each writer checks the ledger as of the number before. (On stores where such a
rename is not atomic let one writer land at a time.)"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlens.schema import SIGNALS
from depotlens.sources.store import stored_bytes

APPEND, REWRITE = "append", "rewrite"
# kind of a commit, its folder and rows; of a rewrite also the last commit whose rows it holds
COMMIT = "commit bigint, operation string, landing string, through bigint, sources array<string>, row_count bigint"
LANDING = "landing_id"
# a rewrite makes files of at least so many bytes
FILE_BYTES = 32 << 20
LEDGER = f"{LANDING} string, batch_id string, row_count bigint"


@dataclass(frozen=True)
class Landed:
    """A commit: its number and rows. ``repeated`` says that it was there before."""

    commit: int
    row_count: int
    repeated: bool = False


@dataclass(frozen=True)
class LandingTable:
    """``batch_column`` names the column of the batch that the ledger counts by."""

    spark: SparkSession
    root: str
    schema: T.StructType = field(default_factory=lambda: SIGNALS)
    batch_column: str = "ingest_batch_id"

    def path(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    def create(self) -> LandingTable:
        """Make the folders, so that a stream can start before the first landing."""
        for name in ("commits", "data", "ledger"):
            system, path = self._located(self.path(name))
            system.mkdirs(path)
        return self

    # log

    def log(self) -> DataFrame:
        return self.spark.read.schema(COMMIT).json(self.path("commits"))

    def commits(self, max_per_batch: int) -> DataFrame:
        """The log as a stream, oldest first. However long a run is put off, no commit is
        too old to be read."""
        reader = self.spark.readStream.schema(COMMIT).option("maxFilesPerTrigger", max_per_batch)
        return reader.option("maxFileAge", "36500d").json(self.path("commits"))

    def _last(self, operation: str | None = None) -> T.Row | None:
        log = self.log().where(F.col("operation") == operation) if operation else self.log()
        return log.orderBy(F.desc("commit")).first()

    def _commit(self, number: int, **entry: object) -> bool:
        """Publish commit ``number``; False if another writer has taken it."""
        jvm = self.spark._jvm
        name = f"{number:020d}.json"
        system, part = self._located(self.path("commits", f"_{uuid.uuid4().hex}"))
        out = system.create(part, False)
        out.write(bytearray(json.dumps({"commit": number, **entry}).encode()))
        out.close()
        final = jvm.org.apache.hadoop.fs.Path(self.path("commits", name))
        conf = self.spark._jsc.hadoopConfiguration()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf)
        plain = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        if system.exists(final):
            system.delete(part, False)
            return False
        try:
            context.rename(system.makeQualified(part), system.makeQualified(final), plain)
        except Exception:
            system.delete(part, False)
            if system.exists(final):
                return False
            raise
        return True

    # landing

    def land(self, rows: DataFrame, sources: Sequence[str] = (), even_files: bool = True) -> Landed | None:
        """Append ``rows``. Without ``sources`` the rows of batches that have landed before
        are left out, and None is returned if no others are there; a batch has to land as a
        whole, and rows without a batch always land. With ``sources`` all rows land,
        unless the sources have landed before."""
        self.create()
        while True:
            last = self._last()
            before = last["commit"] if last else 0
            known = self.landed_sources(sources)
            if known and len(known) == len(set(sources)):
                return Landed(max(known.values()), 0, repeated=True)
            if known:
                raise ValueError(f"{len(known)} of the {len(set(sources))} sources have landed before")
            landing = uuid.uuid4().hex
            counted = self._write(rows if sources else self._without_landed(rows, before), landing, even_files)
            if not counted and not sources:
                self._drop(self.path("data", landing))
                return None
            batches = self._rows(self.path("data", landing)).groupBy(F.col(self.batch_column).cast("string").alias("batch_id"))
            batches.agg(F.count("*").alias("row_count")).coalesce(1).write.parquet(self.path("ledger", landing))
            entry = {"operation": APPEND, "landing": landing, "sources": list(sources), "row_count": counted}
            if self._commit(before + 1, **entry):
                return Landed(before + 1, counted)
            for name in ("data", "ledger"):
                self._drop(self.path(name, landing))

    def landed_sources(self, sources: Sequence[str]) -> dict[str, int]:
        """Those of ``sources`` that have landed, with their commits."""
        if not sources:
            return {}
        listed = self.log().select("commit", F.explode("sources").alias("source"))
        return dict(listed.where(F.col("source").isin(list(sources))).select("source", "commit").collect())

    def _write(self, rows: DataFrame, landing: str, even_files: bool) -> int:
        written = Observation()
        kept = rows.select(*self.schema.names, F.lit(landing).alias(LANDING))
        kept = kept.hint("rebalance") if even_files else kept
        kept.observe(written, F.count("*").alias("rows")).write.parquet(self.path("data", landing))
        return written.get["rows"]

    def _without_landed(self, rows: DataFrame, before: int) -> DataFrame:
        if not before:
            return rows
        landed = self.ledger(before).select(F.col("batch_id").alias("landed_batch")).distinct()
        return rows.join(landed, F.col(self.batch_column).cast("string") == F.col("landed_batch"), "left_anti")

    def ledger(self, through: int | None = None) -> DataFrame:
        """Batches and their rows of all visible landings, with the commit of each."""
        appends = self.log().where(F.col("operation") == APPEND).select("commit", F.col("landing").alias(LANDING))
        if through is not None:
            appends = appends.where(F.col("commit") <= through)
        entries = self.spark.read.option("recursiveFileLookup", "true").schema("batch_id string, row_count bigint")
        listed = entries.parquet(self.path("ledger")).select("*", F.element_at(F.split(F.input_file_name(), "/"), -2).alias(LANDING))
        return listed.join(appends, LANDING)

    # reading

    def _rows(self, *folders: str) -> DataFrame:
        columns = T.StructType([*self.schema.fields, T.StructField(LANDING, T.StringType())])
        return self.spark.read.schema(columns).parquet(*folders)

    def read(self) -> DataFrame:
        """All visible rows, as a batch."""
        rewritten = self._last(REWRITE)
        through = rewritten["through"] if rewritten else 0
        appends = self.log().where((F.col("operation") == APPEND) & (F.col("commit") > through))
        folders = [self.path("data", r["landing"]) for r in appends.select("landing").collect()]
        if rewritten:
            folders.append(self.path("data", rewritten["landing"]))
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self._rows(*folders).drop(LANDING)

    def rows_of(self, appends: Sequence[T.Row]) -> DataFrame:
        """Rows of some landings, wherever they are now."""
        rewritten = self._last(REWRITE)
        through = rewritten["through"] if rewritten else 0
        own = [r["landing"] for r in appends if r["commit"] > through]
        moved = [r["landing"] for r in appends if r["commit"] <= through]
        rows = [self._rows(*(self.path("data", landing) for landing in own))] if own else []
        if moved:
            whole = self._rows(self.path("data", rewritten["landing"]))
            rows.append(whole.where(F.col(LANDING).isin(moved)))
        if not rows:
            return self.spark.createDataFrame([], self.schema)
        return (rows[0] if len(rows) == 1 else rows[0].unionAll(rows[1])).drop(LANDING)

    # upkeep

    def rewrite(self) -> int | None:
        """Write all visible rows into evenly sized files, without a shuffle: the scan splits
        large files and packs small ones, and each task writes one. The rows of a landed file
        stay together, so few row groups hold a landing. Readers and streams get the same
        rows as before; the files that are no longer needed stay until :meth:`drop_rewritten`.
        None if another writer came first."""
        last = self._last()
        if not last:
            return None
        rewritten = self._last(REWRITE)
        through = rewritten["through"] if rewritten else 0
        appends = self.log().where((F.col("operation") == APPEND) & (F.col("commit") > through)).collect()
        if not appends:
            return None
        folders = [self.path("data", r["landing"]) for r in appends]
        if rewritten:
            folders.append(self.path("data", rewritten["landing"]))
        target, counted = uuid.uuid4().hex, Observation()
        files = -(-sum(stored_bytes(self.spark, folder) for folder in folders) // FILE_BYTES)
        rows = self._rows(*folders).coalesce(max(1, files))
        rows.observe(counted, F.count("*").alias("rows")).write.parquet(self.path("data", target))
        entry = {"operation": REWRITE, "landing": target, "through": max(r["commit"] for r in appends), "row_count": counted.get["rows"]}
        if self._commit(last["commit"] + 1, **entry):
            return last["commit"] + 1
        self._drop(self.path("data", target))
        return None

    def drop_rewritten(self) -> int:
        """Drop the data folders whose rows a later rewrite holds; the number of them. Call
        it when no reader is at work that began before the rewrite."""
        rewritten = self._last(REWRITE)
        if not rewritten:
            return 0
        old = F.col("landing").isNotNull() & (F.col("landing") != rewritten["landing"])
        done = ((F.col("operation") == APPEND) & (F.col("commit") <= rewritten["through"])) | (F.col("operation") == REWRITE)
        dropped = 0
        for row in self.log().where(old & done).select("landing").toLocalIterator():
            dropped += self._drop(self.path("data", row["landing"]))
        return dropped

    def _located(self, path: str):
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark._jsc.hadoopConfiguration()), found

    def _drop(self, path: str) -> bool:
        system, found = self._located(path)
        return bool(system.delete(found, True))
