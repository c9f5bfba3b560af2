"""The table graph: signals, bronze, three states, six gold tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.types import StructType

from depotlens.functions.rules import DEFAULT, Limits
from depotlens.operators import serving
from depotlens.operators.measures import State, families, merged_parts, rollup
from depotlens.operators.quality import expect_or_drop
from depotlens.operators.states import EXACT_STATES, STATES
from depotlens.schema import BRONZE, GOLD, SIGNALS, SILVER
from depotlens.sources.parts import FAN_IN, Parts
from depotlens.sources.store import FolderStore, Store, scoped_store
from depotlens.sources.versions import Refresh, VersionedTables
from depotlens.streaming.ingest import IngestReport, follow_table, ingest


def gold_tables(
    silver: dict[str, DataFrame],
    limits: Limits = DEFAULT,
    as_of: Column | None = None,
    store: Store | None = None,
) -> dict[str, DataFrame]:
    """The gold tables over the three states. With a ``store`` each is written and
    read back, so that tables built on others read them instead of their plans."""

    def kept(name: str, frame: DataFrame) -> DataFrame:
        return store.write(name, frame) if store else frame

    inventory, demand, dispatch = (silver[name] for name in SILVER)
    visibility, planner, forecast, exposure, sales, decided = GOLD
    gold = {
        visibility: kept(visibility, serving.inventory_visibility(inventory, limits)),
        planner: kept(planner, serving.planner_explainability(inventory, demand, limits)),
        forecast: kept(forecast, serving.demand_forecast(demand, limits)),
        exposure: kept(exposure, serving.dispatch_exposure(dispatch, limits)),
    }
    gold[sales] = kept(sales, serving.sales_context(gold[forecast], limits))
    tasks = serving.decision_tasks(gold[planner], gold[exposure]) if store else None
    actions = serving.decisions(
        gold[planner], gold[forecast], gold[exposure], limits, as_of, tasks=tasks
    )
    gold[decided] = kept(decided, actions)
    return gold


def build_all(
    signals: DataFrame, limits: Limits = DEFAULT, as_of: Column | None = None
) -> dict[str, DataFrame]:
    """Every table as a lazy plan over the signals; starts no job. Each table scans
    the signals anew, so for volumes use :func:`materialize`."""
    bronze = expect_or_drop(signals)
    silver = {name: state.from_signals(bronze) for name, state in STATES.items()}
    return {BRONZE[0]: bronze, **silver, **gold_tables(silver, limits, as_of)}


def planned_states(
    bronze: DataFrame, work: Store, states: Mapping[str, State] = STATES
) -> dict[str, DataFrame]:
    """Plans of the states. Where several share a rollup it is written to ``work``
    first, so that each family of states reads the signals once, and only its columns."""
    plans: dict[str, DataFrame] = {}
    for family in families(states):
        if len(family) == 1:
            plans.update({name: state.from_signals(bronze) for name, state in family.items()})
        else:
            parts = work.write(parts_name(family), rollup(bronze, family.values()))
            plans.update({name: state.from_rollup(parts) for name, state in family.items()})
    return plans


def parts_name(family: Mapping[str, State]) -> str:
    return f"{next(iter(family))}_parts"


def materialize(
    bronze: DataFrame, store: Store | Refresh, limits: Limits = DEFAULT, as_of: Column | None = None
) -> dict[str, DataFrame]:
    """Refresh all silver and gold tables of ``store`` from a stored bronze table.

    Only the states read bronze; everything later works on aggregates. Each table
    is replaced as a whole, so a refresh can be repeated, also after a failed one. The
    averages are exact, so a repeated refresh gives the same bits."""
    with scoped_store(bronze.sparkSession) as work:
        plans = planned_states(bronze, work, EXACT_STATES)
        silver = {name: store.write(name, plans[name]) for name in SILVER}
    return {**silver, **gold_tables(silver, limits, as_of, store)}


def refresh(
    bronze: DataFrame, tables: VersionedTables, limits: Limits = DEFAULT, as_of: Column | None = None
) -> dict[str, DataFrame]:
    """Like :func:`materialize`, but readers see all nine tables change at once, after the
    last is written. A failed refresh leaves them as they were."""
    attempt = tables.begin()
    materialize(bronze, attempt, limits, as_of)
    tables.publish(attempt)
    return {name: tables.read(name) for name in (*SILVER, *GOLD)}


def update(
    store: Store,
    checkpoint: str,
    schema: StructType = SIGNALS,
    limits: Limits = DEFAULT,
    as_of: Column | None = None,
    max_bytes_per_batch: int | None = None,
) -> tuple[IngestReport, dict[str, DataFrame]]:
    """One triggered run: stream what landed into bronze, then refresh the tables.
    The states are computed anew from all of bronze; see :func:`update_states`."""
    report = ingest(store, checkpoint, schema, max_bytes_per_batch=max_bytes_per_batch)
    return report, materialize(store.read(BRONZE[0]), store, limits, as_of)


def update_states(
    store: Store,
    checkpoint: str,
    parts: FolderStore,
    schema: StructType = SIGNALS,
    limits: Limits = DEFAULT,
    as_of: Column | None = None,
    max_bytes_per_batch: int | None = None,
) -> tuple[IngestReport, IngestReport, dict[str, DataFrame]]:
    """Like :func:`update`, but only new signals are read.

    A second stream follows bronze and adds the rollup of each of its batches to
    ``parts``; the states are merged from those. The reports are of both streams. The
    averages are exact, so they are those of :func:`update`."""
    landed = ingest(store, f"{checkpoint}/bronze", schema, max_bytes_per_batch=max_bytes_per_batch)
    rolled = roll_up_new(
        store, f"{checkpoint}/parts", parts, schema, families(EXACT_STATES), max_bytes_per_batch
    )
    plans = states_from_parts(parts, EXACT_STATES)
    silver = {name: store.write(name, plans[name]) for name in SILVER}
    return landed, rolled, {**silver, **gold_tables(silver, limits, as_of, store)}


def roll_up_new(
    store: Store,
    checkpoint: str,
    parts: FolderStore,
    schema: StructType,
    wanted: Sequence[Mapping[str, State]],
    max_bytes_per_batch: int | None = None,
    fan_in: int = FAN_IN,
) -> IngestReport:
    """Rollups of the signals that reached bronze since the last run, one part per batch of
    the stream. A repeated batch replaces its part, so it counts once, and older parts are
    merged, so few are left."""

    def keep(batch: DataFrame, number: int) -> None:
        for family in wanted:
            family_parts(parts, family, fan_in).add(number, rollup(batch, family.values()))

    return follow_table(store, BRONZE[0], checkpoint, schema, keep, max_bytes_per_batch)


def family_parts(parts: FolderStore, family: Mapping[str, State], fan_in: int = FAN_IN) -> Parts:
    return Parts(parts, parts_name(family), lambda rolled: merged_parts(rolled, family.values()), fan_in)


def states_from_parts(parts: FolderStore, states: Mapping[str, State] = STATES) -> dict[str, DataFrame]:
    plans: dict[str, DataFrame] = {}
    for family in families(states):
        rolled = family_parts(parts, family).read()
        plans.update({name: state.from_rollup(rolled) for name, state in family.items()})
    return plans
