"""Tables that are refreshed together: readers see all of one refresh, never a mixture.

A refresh writes every table as a new version, in a folder that no reader looks at. One
statement of the catalog then replaces a view that names the current version; the tables are
views that read the version it names. A refresh that fails on its way leaves all tables as they
were, and its folders go with the old versions, after a time that lets running queries end.

    <root>/<table>/version=v20240501…-1a2b3c4d/part-….parquet
    <namespace>.current_version            SELECT 'v20240501…-1a2b3c4d' AS version
    <namespace>.<table>                    the rows of that version"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from depotlens.functions.scalars import sql_quoted

POINTER = "current_version"
VERSION = "version"
_STAMP = "%Y%m%d%H%M%S%f"


@dataclass
class Refresh:
    """A store for the tables of one refresh. Nothing of it is visible before
    :meth:`VersionedTables.publish`."""

    tables: VersionedTables
    version: str
    written: dict[str, list[str]] = field(default_factory=dict)

    @property
    def spark(self) -> SparkSession:
        return self.tables.spark

    def path(self, name: str) -> str:
        return f"{self.tables.path(name)}/{VERSION}={self.version}"

    def write(self, name: str, frame: DataFrame) -> DataFrame:
        frame.write.format(self.tables.format).mode("overwrite").save(self.path(name))
        self.written[name] = frame.columns
        return self.spark.read.format(self.tables.format).schema(frame.schema).load(self.path(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.format(self.tables.format).load(self.path(name))


@dataclass(frozen=True)
class VersionedTables:
    spark: SparkSession
    namespace: str
    root: str
    format: str = "parquet"

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def full_name(self, name: str) -> str:
        return f"`{self.namespace}`.`{name}`"

    def begin(self, now: datetime | None = None) -> Refresh:
        moment = (now or datetime.now(timezone.utc)).strftime(_STAMP)
        return Refresh(self, f"v{moment}-{uuid.uuid4().hex[:8]}")

    def names(self) -> list[str]:
        """Tables that readers see."""
        if not self.spark.catalog.databaseExists(f"`{self.namespace}`"):
            return []
        views = self.spark.sql(f"SHOW VIEWS IN `{self.namespace}`").where("not isTemporary")
        return sorted(r["viewName"] for r in views.collect() if r["viewName"] != POINTER)

    def current(self) -> str | None:
        """The version that readers see."""
        if not self.spark.catalog.databaseExists(f"`{self.namespace}`"):
            return None
        shown = self.spark.sql(f"SHOW VIEWS IN `{self.namespace}` LIKE '{POINTER}'").count()
        return self.spark.table(self.full_name(POINTER)).first()[VERSION] if shown else None

    def publish(self, refresh: Refresh) -> None:
        """Let readers see the tables of ``refresh`` instead of those before, all at once.

        Tables keep their columns from refresh to refresh, and none may be left out: both
        are checked before anything is changed."""
        known = self.names()
        missing = [name for name in known if name not in refresh.written]
        if missing:
            raise ValueError(f"the refresh lacks {', '.join(missing)}")
        for name in known:
            if self.read(name).columns != refresh.written[name]:
                raise ValueError(f"{name} has other columns than before")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.namespace}`")
        if self.current() is None:
            self._point(refresh.version)
        # new tables first: they have no rows of the version before
        for name in refresh.written:
            if name not in known:
                self._create(name, refresh.written[name])
        self._point(refresh.version)

    def _point(self, version: str) -> None:
        chosen = f"SELECT {sql_quoted(version)} AS {VERSION}"
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.full_name(POINTER)} AS {chosen}")

    def _create(self, name: str, columns: list[str]) -> None:
        listed = ", ".join("`" + c.replace("`", "``") + "`" for c in columns)
        source = f"{self.format}.`{self.path(name)}`"
        chosen = f"{VERSION} = (SELECT {VERSION} FROM {self.full_name(POINTER)})"
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.full_name(name)} AS SELECT {listed} FROM {source} WHERE {chosen}")

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.full_name(name))

    def expire(self, keep: timedelta, now: datetime | None = None) -> list[str]:
        """Drop the versions begun longer than ``keep`` ago, but never the current one; the
        folders dropped. ``keep`` has to exceed the longest query and the longest refresh."""
        oldest = f"v{((now or datetime.now(timezone.utc)) - keep).strftime(_STAMP)}"
        current = self.current()
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        system = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        dropped = []
        for folder in system.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.path('*')}/{VERSION}=*")) or []:
            path = folder.getPath()
            version = path.getName().removeprefix(f"{VERSION}=")
            if version != current and version < oldest:
                system.delete(path, True)
                dropped.append(f"{path.getParent().getName()}/{version}")
        return sorted(dropped)
