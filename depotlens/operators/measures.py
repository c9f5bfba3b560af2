"""Group states described once and planned two ways.

A state (keys plus measures) can be computed straight from the signals, or from
a rollup: the signals pre-aggregated to the finest key any of several states
needs, with mergeable parts (sums, counts, maxima). States over one rollup share
one pass over the signals. What the pass shuffles depends on the number of finest
groups, see :func:`families`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotlens.operators.spread import dealt, exceeds

# how a part is combined, given its name and the aggregate that merges it
Combine = Callable[[str, Callable[[str], Column]], Column]


def grouped(name: str, merge: Callable[[str], Column]) -> Column:
    return merge(name)


@dataclass(frozen=True)
class Mean:
    """Average of the non-null values, NULL if there are none."""

    column: str

    def direct(self) -> Column:
        return F.avg(self.column)

    def parts(self) -> dict[str, Column]:
        return {
            f"{self.column}__sum": F.sum(self.column),
            f"{self.column}__known": F.count(self.column),
        }

    def merged(self, combine: Combine = grouped) -> Column:
        return F.try_divide(combine(f"{self.column}__sum", F.sum), combine(f"{self.column}__known", F.sum))

    grain = ()


# An exact sum keeps five integers of each double below 2^62:
#   |x| = a 2^24 + b + c 2^-24 + d 2^-48 + e 2^-62,  b, c, d < 2^24 and e < 2^14,
# each with the sign of x. What lies below 2^-62 is cut off, value by value.
_WIDTH, _LAST = 24, 14
_MASK = (1 << _WIDTH) - 1
_LIMBS = ("a", "b", "c", "d", "e")
_REACH = float(1 << 62)


def exact_limbs(value: Column) -> dict[str, Column]:
    """The five integers of a double below 2^62. Every step is exact: a rounding down, the
    difference to it, and a product with a power of two."""
    size = F.abs(value)
    whole = F.floor(size)
    limbs = [F.shiftright(whole, _WIDTH), whole.bitwiseAND(F.lit(_MASK))]
    rest = size - whole.cast("double")
    for bits in (_WIDTH, _WIDTH, _LAST):
        rest = rest * F.lit(2.0**bits)
        limbs.append(F.floor(rest))
        rest = rest - F.floor(rest).cast("double")
    return {k: F.when(value < 0, -limb).otherwise(limb) for k, limb in zip(_LIMBS, limbs, strict=True)}


def exact_total(sums: dict[str, Column]) -> Column:
    """The double next to the number that sums of the five integers stand for."""
    a, b, c, d, e = (sums[k].cast("decimal(20,0)") for k in _LIMBS)

    def shifted(value: Column, bits: int) -> Column:
        return value * F.lit(1 << bits).cast(f"decimal({len(str(1 << bits))},0)")

    # the decimal holds the whole number if the first sum is below 2^37, and is rounded
    # once; beyond that the bits below one don't reach the double
    whole = shifted(a, _WIDTH) + b
    near = shifted(whole, 62) + shifted(c, _WIDTH + _LAST) + shifted(d, _LAST) + e
    return F.when(F.abs(sums["a"]) < F.lit(1 << 37), near.cast("double") * F.lit(2.0**-62)).otherwise(whole.cast("double"))


@dataclass(frozen=True)
class ExactMean(Mean):
    """Average that doesn't depend on the order of the rows, nor on how they were merged: the
    sum is exact (to 2^-62 a value) and rounded once. Infinite values, NaN and values beyond
    2^62 are summed as doubles.

    The parts are sums of integers below 2^24 (the first: below 2^38), so a group holds 2^39
    rows with values below 2^48; beyond that the sum fails rather than wraps."""

    def _split(self) -> dict[str, Column]:
        value = F.col(self.column).cast("double")
        inside = F.abs(value) < F.lit(_REACH)
        limbs = exact_limbs(F.when(inside, value))
        return {**limbs, "other": F.when(~inside, value)}

    def parts(self) -> dict[str, Column]:
        sums = {f"{self.column}__{k}": F.sum(v) for k, v in self._split().items()}
        return {**sums, f"{self.column}__known": F.count(self.column)}

    def _mean(self, sums: dict[str, Column], known: Column) -> Column:
        total = F.coalesce(exact_total(sums), F.lit(0.0))
        return F.try_divide(F.when(sums["other"].isNull(), total).otherwise(total + sums["other"]), known)

    def direct(self) -> Column:
        return self._mean({k: F.sum(v) for k, v in self._split().items()}, F.count(self.column))

    def merged(self, combine: Combine = grouped) -> Column:
        sums = {k: combine(f"{self.column}__{k}", F.sum) for k in (*_LIMBS, "other")}
        return self._mean(sums, combine(f"{self.column}__known", F.sum))


@dataclass(frozen=True)
class Peak:
    """Largest value; works for times as well as numbers."""

    column: str

    def direct(self) -> Column:
        return F.max(self.column)

    def parts(self) -> dict[str, Column]:
        return {f"{self.column}__max": F.max(self.column)}

    def merged(self, combine: Combine = grouped) -> Column:
        return combine(f"{self.column}__max", F.max)

    grain = ()


@dataclass(frozen=True)
class Hits:
    """Number of rows on which a condition is true."""

    label: str
    condition: Callable[[], Column]

    def direct(self) -> Column:
        return F.count_if(self.condition())

    def parts(self) -> dict[str, Column]:
        return {f"{self.label}__hits": F.count_if(self.condition())}

    def merged(self, combine: Combine = grouped) -> Column:
        return combine(f"{self.label}__hits", F.sum)

    grain = ()


@dataclass(frozen=True)
class Distinct:
    """Exact number of different non-null values. In a rollup the column becomes
    part of the key, so a hot group is spread over its values."""

    column: str

    def direct(self) -> Column:
        return F.count_distinct(self.column)

    def parts(self) -> dict[str, Column]:
        return {}

    def merged(self) -> Column:
        return F.count_distinct(self.column)

    @property
    def grain(self) -> tuple[str, ...]:
        return (self.column,)

    @property
    def dealt_by(self) -> tuple[str, ...]:
        """Columns that spread a group's rollup over tasks."""
        return self.grain

    def derived(self) -> dict[str, Column]:
        """Columns of the rollup's key that signals don't have."""
        return {}


# what a group's values are dealt to
SHARES = 64


@dataclass(frozen=True)
class SharedDistinct(Distinct):
    """The same number where groups are as many as rows, or nearly: the values of a group are
    dealt to shares by their hash, and the counts of the shares add up. A hot group is spread
    over its shares, and nothing but their counts meets. The rollup must have one row for each
    group and value, as :func:`rollup` and :func:`merged_parts` make it."""

    @property
    def grain(self) -> tuple[str, ...]:
        return (*self.dealt_by, self.column)

    @property
    def dealt_by(self) -> tuple[str, ...]:
        return (f"{self.column}__share",)

    def derived(self) -> dict[str, Column]:
        return {f"{self.column}__share": F.pmod(F.xxhash64(self.column), F.lit(SHARES))}

    def merged(self) -> Column:
        return F.count(self.column)


@dataclass(frozen=True)
class BitmapDistinct(Distinct):
    """The same number from bitmaps of numbered values (``<column>__number``, see
    ``sources.numbers``). A rollup has a row per group and range of 64 numbers instead of one
    per group and value. A bitmap is one integer: a group of few values takes as little as
    they do, and hash aggregation updates it in place. :func:`merged_parts` must have made
    one row of each before the state is taken from it."""

    def _number(self) -> Column:
        return F.col(f"{self.column}__number")

    def parts(self) -> dict[str, Column]:
        place = self._number().bitwiseAND(F.lit(63)).cast("int")
        return {f"{self.column}__bits": F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))}

    def merged(self) -> Column:
        return F.coalesce(F.sum(F.bit_count(f"{self.column}__bits").cast("bigint")), F.lit(0))

    @property
    def grain(self) -> tuple[str, ...]:
        return (f"{self.column}__word",)

    def derived(self) -> dict[str, Column]:
        return {f"{self.column}__word": F.shiftright(self._number(), 6)}


@dataclass(frozen=True)
class State:
    keys: tuple[str, ...]
    measures: dict[str, Mean | Peak | Hits | Distinct]
    derived: dict[str, Callable[[], Column]] = field(default_factory=dict)

    def grain(self) -> tuple[str, ...]:
        return self.keys + tuple(c for m in self.measures.values() for c in m.grain)

    def from_signals(self, signals: DataFrame) -> DataFrame:
        return self._group(signals, {n: m.direct() for n, m in self.measures.items()})

    def from_many(self, signals: DataFrame, tasks: int) -> DataFrame:
        """:meth:`from_signals` for groups that grow with the data, in ``tasks`` tasks."""
        shared = self.by_shares()
        if shared == self:
            return self.from_signals(dealt(signals, tasks, *self.keys))
        return shared.from_shares(rollup(signals, [shared], tasks), tasks)

    def from_rollup(self, rolled: DataFrame) -> DataFrame:
        return self._group(rolled, {n: m.merged() for n, m in self.measures.items()})

    def dealt_by(self) -> tuple[str, ...]:
        """Columns that spread a rollup over tasks so that each group of it is in one."""
        return self.keys + tuple(c for m in self.measures.values() if isinstance(m, Distinct) for c in m.dealt_by)

    def from_shares(self, rolled: DataFrame, tasks: int) -> DataFrame:
        """:meth:`from_rollup` of a rollup that is dealt by :meth:`dealt_by`, for groups that grow
        with the data: each share of a group becomes a row where it is, and ``tasks`` tasks
        merge those rows."""
        counts = {n: m for n, m in self.measures.items() if isinstance(m, Distinct)}
        if not counts or not exceeds(rolled, tasks):
            return self.from_rollup(rolled)
        others = {n: m for n, m in self.measures.items() if n not in counts}
        parts = {part: _merge(m, part) for m in others.values() for part in m.parts()}
        parts |= {f"{n}__counted": m.merged() for n, m in counts.items()}
        shares = rolled.groupBy(*self.dealt_by()).agg(*[c.alias(n) for n, c in parts.items()])
        whole = {n: F.sum(f"{n}__counted") if n in counts else m.merged() for n, m in self.measures.items()}
        return self._group(dealt(shares, tasks, *self.keys), whole)

    def beside(self) -> dict[str, Column]:
        """The measures as window values over a rollup of finer groups, so that each of its
        rows has those of its group of this state without a join."""
        group = Window.partitionBy(*self.keys)
        return {n: m.merged(lambda name, merge: merge(name).over(group)) for n, m in self.measures.items()}

    def of_row(self) -> dict[str, Column]:
        """The measures over a rollup to exactly this state's groups, row by row."""
        return {n: m.merged(lambda name, _: F.col(name)) for n, m in self.measures.items()}

    def exactly(self) -> State:
        """The same state with averages that no order of the rows changes."""
        exact = {n: ExactMean(m.column) if isinstance(m, Mean) else m for n, m in self.measures.items()}
        return replace(self, measures=exact)

    def by_bitmaps(self) -> State:
        """The same state with distinct counts from bitmaps."""
        found = {n: BitmapDistinct(m.column) if isinstance(m, Distinct) else m for n, m in self.measures.items()}
        return replace(self, measures=found)

    def by_shares(self) -> State:
        """The same state with distinct counts from shares, for :meth:`from_shares`."""
        found = {n: SharedDistinct(m.column) if isinstance(m, Distinct) else m for n, m in self.measures.items()}
        return replace(self, measures=found)

    def _group(self, frame: DataFrame, columns: dict[str, Column]) -> DataFrame:
        grouped = frame.groupBy(*self.keys).agg(*[c.alias(n) for n, c in columns.items()])
        return grouped.withColumns({n: build() for n, build in self.derived.items()})


def rollup(signals: DataFrame, states: Iterable[State], tasks: int = 0) -> DataFrame:
    """One row per finest group with the parts that ``states`` can be merged from.

    Where groups are as many as rows, or nearly, map-side aggregation is of no use: ``tasks``
    deals the rows to so many tasks first, see :func:`spread.dealt`."""
    grain: dict[str, None] = {}
    keys: dict[str, None] = {}
    parts: dict[str, Column] = {}
    for state in states:
        grain.update(dict.fromkeys(state.grain()))
        keys.update(dict.fromkeys(state.dealt_by()))
        for measure in state.measures.values():
            parts.update(measure.parts())
            if isinstance(measure, Distinct):
                signals = signals.withColumns(measure.derived())
    signals = dealt(signals, tasks, *keys)
    return signals.groupBy(*grain).agg(*[c.alias(n) for n, c in parts.items()])


def merged_parts(rolled: DataFrame, states: Iterable[State], tasks: int = 0) -> DataFrame:
    """Several rollups, one after another in ``rolled``, as one of the same columns. ``tasks``
    is that of :func:`rollup`; rollups that are dealt alike stay where they are without it."""
    grain: dict[str, None] = {}
    keys: dict[str, None] = {}
    parts: dict[str, Column] = {}
    for state in states:
        grain.update(dict.fromkeys(state.grain()))
        keys.update(dict.fromkeys(state.dealt_by()))
        for measure in state.measures.values():
            parts.update({n: _merge(measure, n) for n in measure.parts()})
    return dealt(rolled, tasks, *keys).groupBy(*grain).agg(*[c.alias(n) for n, c in parts.items()])


def _merge(measure: Mean | Peak | Hits | Distinct, part: str) -> Column:
    if isinstance(measure, Peak):
        return F.max(part)
    return F.bit_or(part) if isinstance(measure, BitmapDistinct) else F.sum(part)


def families(states: Mapping[str, State]) -> list[dict[str, State]]:
    """States that share a rollup.

    A state joins another only if its groups are unions of the other's, so no rollup
    has more groups than a state that is wanted anyway, and map-side aggregation
    shrinks it as well as it can."""
    found: list[dict[str, State]] = []
    for name, state in sorted(states.items(), key=lambda item: -len(item[1].grain())):
        for family in found:
            finest = next(iter(family.values()))
            if set(state.grain()) <= set(finest.grain()):
                family[name] = state
                break
        else:
            found.append({name: state})
    return found
