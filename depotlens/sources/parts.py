"""Mergeable parts of a stream's batches, kept few by merging them in tiers.

Every batch writes a folder of its own. Once a tier has ``fan_in`` folders the oldest of them
are merged into one of the next tier, so after n batches about ``fan_in`` * log(n) folders are
left, and a row is rewritten log(n) times. A folder's name tells the batches it holds; one that
lies within the batches of a larger folder is passed over, which makes every step repeatable:
a merge that ended before its sources were dropped, or a batch that comes again after it was
merged, changes nothing."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from depotlens.sources.store import FolderStore

FAN_IN = 8
_NAMES = re.compile(r"batch=(?P<only>\d+)|merged=(?P<tier>\d+)-(?P<first>\d+)-(?P<last>\d+)")


@dataclass(frozen=True, order=True)
class Span:
    """A folder of the batches ``first`` to ``last``."""

    first: int
    last: int
    tier: int

    @property
    def folder(self) -> str:
        return f"merged={self.tier}-{self.first}-{self.last}" if self.tier else f"batch={self.first}"

    @classmethod
    def of(cls, folder: str) -> Span | None:
        found = _NAMES.fullmatch(folder)
        if not found:
            return None
        if found["only"]:
            return cls(int(found["only"]), int(found["only"]), 0)
        return cls(int(found["first"]), int(found["last"]), int(found["tier"]))

    def holds(self, other: Span) -> bool:
        return self.tier > other.tier and self.first <= other.first and other.last <= self.last


@dataclass(frozen=True)
class Parts:
    """Parts below one folder of ``store``; ``merge`` makes one part of several."""

    store: FolderStore
    name: str
    merge: Callable[[DataFrame], DataFrame]
    fan_in: int = FAN_IN

    def __post_init__(self) -> None:
        if self.fan_in < 2:
            raise ValueError("fan_in must be at least 2")

    def spans(self) -> list[Span]:
        """The finished folders that hold every batch once, oldest first."""
        found = [span for span in map(Span.of, self.store.finished(self.name)) if span]
        return sorted(s for s in found if not any(o.holds(s) for o in found))

    def add(self, number: int, rows: DataFrame) -> None:
        """Keep the part of batch ``number``, replacing what an earlier attempt left."""
        span = Span(number, number, 0)
        if not any(other.holds(span) for other in self.spans()):
            self.store.write(f"{self.name}/{span.folder}", rows)
        tier = 0
        while True:
            full = [s for s in self.spans() if s.tier == tier]
            if len(full) < self.fan_in:
                break
            self._merge(full[: self.fan_in], tier + 1)
            tier += 1
        self._drop_merged()

    def _merge(self, spans: list[Span], tier: int) -> None:
        whole = Span(spans[0].first, spans[-1].last, tier)
        self.store.write(f"{self.name}/{whole.folder}", self.merge(self._load(spans)))

    def _load(self, spans: list[Span]) -> DataFrame:
        paths = [self.store.path(f"{self.name}/{s.folder}") for s in spans]
        return self.store.spark.read.format(self.store.format).load(paths)

    def _drop_merged(self) -> None:
        kept = set(self.spans())
        for folder in self.store.finished(self.name):
            span = Span.of(folder)
            if span and span not in kept:
                self.store.remove(f"{self.name}/{folder}")

    def read(self) -> DataFrame:
        """The parts of all batches."""
        return self._load(self.spans())
