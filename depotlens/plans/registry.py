"""Every query by name, over a folder of order tables.

Queries are lazy plans over the signals, except those that land, stream or store tables:
these write to a working store in the cluster's shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.functions.scalars import IDS_PER_MILLISECOND, source_name
from depotlens.operators import serving, states
from depotlens.operators.measures import families, merged_parts, rollup
from depotlens.operators.quality import expect_or_drop, expectation_counts
from depotlens.plans import graph, publish, reports
from depotlens.plans.differences import differences
from depotlens.schema import BRONZE, GOLD, KEYS, LANE, OFFER, POSITION, SILVER
from depotlens.sources.clustered import ClusteredTable
from depotlens.sources.landing import LandingTable
from depotlens.sources.numbers import Numbers
from depotlens.sources.signals import append_batch, line_tasks, read_table, replay_batch, signals_from, stamp_batch
from depotlens.sources.store import CatalogStore, FolderStore, working_store
from depotlens.sources.versions import VersionedTables
from depotlens.streaming.ingest import ingest, ingest_commits

Query = Callable[[SparkSession, str], DataFrame]

# Clock of the registered queries, so that their results can be compared.
AS_OF = datetime(2001, 2, 3, 4, 5, 6)
BATCH_TAG = "orders"
LANDING_GAP_MS = 1000
REPLAY_HOURS = 72
# Market and product of the question about planner decisions, and the market that the
# drifted copy lacks.
ASKED = ("MKT-03", "PRD-02")
DRIFTED = "MKT-07"
RENAMED = ("MKT-09", "MKT-x9")
ASKED_TERMINAL = "TRM-004"
INVENTORY, DEMAND, DISPATCH = SILVER
VISIBILITY, PLANNER, FORECAST, EXPOSURE, SALES, DECISIONS = GOLD


def _clock() -> Column:
    return F.lit(f"{AS_OF}").cast("timestamp_ntz")


def _bronze(spark: SparkSession, folder: str) -> DataFrame:
    return expect_or_drop(signals_from(spark, folder, BATCH_TAG))


def _states(spark: SparkSession, folder: str, *names: str, wide: bool = False) -> dict[str, DataFrame]:
    bronze = expect_or_drop(signals_from(spark, folder, BATCH_TAG, wide))
    found = {name: states.STATES[name] for name in names or SILVER}
    if not wide:
        return {name: state.from_signals(bronze) for name, state in found.items()}
    tasks = line_tasks(spark, folder)
    # lanes and positions are as many as the suppliers allow, offers are not
    return {
        name: state.from_many(bronze, tasks) if "terminal_id" in state.keys else state.from_signals(bronze)
        for name, state in found.items()
    }


# sources and quality


def conform_signals(spark: SparkSession, folder: str) -> DataFrame:
    return signals_from(spark, folder, BATCH_TAG)


def stamped_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches landed a second apart. Ids count from the first batch's start, since
    they hold milliseconds since 1970 in UTC."""
    signals = signals_from(spark, folder, BATCH_TAG)
    first = _clock().cast("timestamp")
    later = first + F.make_dt_interval(secs=F.lit(LANDING_GAP_MS / 1000))
    start = F.unix_millis(first) * F.lit(IDS_PER_MILLISECOND)
    halves = []
    for half, landed in enumerate((first, later)):
        rows = signals.where(F.pmod("id", F.lit(2)) == half)
        stamped = stamp_batch(rows, BATCH_TAG, landed, LANDING_GAP_MS)
        halves.append(
            stamped.select(
                (F.col("id") - start).alias("id_since_start"),
                "source_record_id",
                "ingest_batch_id",
                "record_created_ts",
            )
        )
    return halves[0].unionAll(halves[1])


def replayed_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Signals of every market and hour in a batch that is replayed over three days."""
    replayed = replay_batch(signals_from(spark, folder, BATCH_TAG), _clock(), REPLAY_HOURS)
    return replayed.groupBy("market_key", "signal_timestamp").agg(F.count("*").alias("row_count"))


def source_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Source system of every order, with indexes beyond both ends of the list."""
    index = F.col("o_orderkey") % 17 - 2
    orders = read_table(spark, folder, "orders")
    return orders.select("o_orderkey", source_name(index).alias("source_system"))


def bronze_signals(spark: SparkSession, folder: str) -> DataFrame:
    return _bronze(spark, folder)


def expectation_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return expectation_counts(signals_from(spark, folder, BATCH_TAG))


def _landings(signals: DataFrame) -> list[DataFrame]:
    """The signals in two landings, by the parity of their id."""
    return [signals.where(F.pmod("id", F.lit(2)) == half) for half in range(2)]


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Land the signals in two batches and stream each into bronze, with the number of
    rows that each run read."""
    store = working_store(spark)
    signals = signals_from(spark, folder, BATCH_TAG)
    reports = []
    for batch in _landings(signals):
        append_batch(batch, store)
        reports.append(ingest(store, store.path("progress"), signals.schema))
    passed = [F.lit(r.counters["valid_source_system_passed"]).cast("bigint") for r in reports]
    half = F.pmod("id", F.lit(2))
    return store.read(BRONZE[0]).withColumn("passed_in_run", F.when(half == 0, passed[0]).otherwise(passed[1]))


def _updated_states(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """States after two landings and two updates, each of which reads only new signals."""
    store = working_store(spark)
    parts = FolderStore(spark, store.path("parts"))
    signals = signals_from(spark, folder, BATCH_TAG)
    for batch in _landings(signals):
        append_batch(batch, store)
        ingest(store, store.path("progress/bronze"), signals.schema)
        wanted = families(states.EXACT_STATES)
        graph.roll_up_new(store, store.path("progress/parts"), parts, signals.schema, wanted)
    return graph.states_from_parts(parts, states.EXACT_STATES)


def incremental_states(spark: SparkSession, folder: str) -> DataFrame:
    """Inventory positions with the demand picture, from states kept up to date by parts."""
    silver = _updated_states(spark, folder)
    return serving.planner_explainability(silver[INVENTORY], silver[DEMAND])


def incremental_dispatch(spark: SparkSession, folder: str) -> DataFrame:
    return _updated_states(spark, folder)[DISPATCH]


def _landed(spark: SparkSession, folder: str) -> tuple[LandingTable, list[DataFrame]]:
    """An empty landing table, and the signals as two batches for it."""
    signals = signals_from(spark, folder, BATCH_TAG)
    landing = LandingTable(spark, working_store(spark).path("landing"), signals.schema)
    named = F.concat("ingest_batch_id", F.lit("-"), F.pmod("id", F.lit(2)).cast("string"))
    return landing, _landings(signals.withColumn("ingest_batch_id", named))


def stream_commits(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze after two landings, each followed by a run of the stream, though the landed
    files are rewritten into others before and between the runs, and the first ones go. As
    the rewrite makes the files even, the landings need not."""
    landing, batches = _landed(spark, folder)
    bronze = LandingTable(spark, landing.path("bronze"), landing.schema)
    for batch in batches:
        landing.land(batch, even_files=False)
        landing.rewrite()
        landing.drop_rewritten()
        ingest_commits(landing, bronze, landing.path("progress"))
        landing.rewrite()
        ingest_commits(landing, bronze, landing.path("progress"))
    return bronze.read()


def stream_repeated_landing(spark: SparkSession, folder: str) -> DataFrame:
    """The landing table after the first batch has landed twice, and again together with
    the second: its rows are those of one landing of each."""
    landing, (first, second) = _landed(spark, folder)
    for batch in (first, first, first.unionAll(second), second):
        landing.land(batch)
    entries = landing.ledger().select(F.col("batch_id").alias("ingest_batch_id"), F.col("row_count").alias("rows_in_ledger"))
    return landing.read().join(entries, "ingest_batch_id")


def incremental_dispatch_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Lanes of every supplier after two batches, from parts that keep the locations served
    as bitmaps of numbered locations."""
    tasks = line_tasks(spark, folder)
    store = FolderStore(spark, working_store(spark).path("parts"))
    dispatch = states.DISPATCH.exactly().by_bitmaps()
    parts = graph.family_parts(store, {DISPATCH: dispatch})
    locations = Numbers(store, "retail_location_id")
    bronze = expect_or_drop(signals_from(spark, folder, BATCH_TAG, wide=True))
    for number, batch in enumerate(_landings(bronze)):
        parts.add(number, rollup(locations.numbered(number, batch), [dispatch], tasks))
    return dispatch.from_shares(merged_parts(parts.read(), [dispatch], tasks), tasks)


def raw_signals_by_source(spark: SparkSession, folder: str) -> DataFrame:
    return reports.signals_by_source(signals_from(spark, folder, BATCH_TAG))


def signals_by_source(spark: SparkSession, folder: str) -> DataFrame:
    return reports.signals_by_source(_bronze(spark, folder))


# states


def inventory_state(spark: SparkSession, folder: str) -> DataFrame:
    return states.inventory_state(_bronze(spark, folder))


def demand_drivers(spark: SparkSession, folder: str) -> DataFrame:
    return states.demand_drivers(_bronze(spark, folder))


def dispatch_context(spark: SparkSession, folder: str) -> DataFrame:
    return states.dispatch_context(_bronze(spark, folder))


def dispatch_context_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Lanes of every supplier; their number grows with the data."""
    return _states(spark, folder, DISPATCH, wide=True)[DISPATCH]


def _priced(spark: SparkSession, folder: str, wide: bool = False) -> DataFrame:
    return expect_or_drop(signals_from(spark, folder, BATCH_TAG, wide, priced=True))


def exact_planner(spark: SparkSession, folder: str) -> DataFrame:
    """Inventory positions with averages of prices, the same bits in any order of rows."""
    bronze = _priced(spark, folder)
    silver = {name: states.EXACT_STATES[name].from_signals(bronze) for name in (INVENTORY, DEMAND)}
    return serving.planner_explainability(silver[INVENTORY], silver[DEMAND])


def exact_dispatch(spark: SparkSession, folder: str) -> DataFrame:
    """Lanes of every supplier from merged parts, with averages of prices: the rollups of
    three parts of the signals, dealt by a hash."""
    bronze, tasks = _priced(spark, folder, wide=True), line_tasks(spark, folder)
    dispatch = states.EXACT_STATES[DISPATCH].by_shares()
    part = F.pmod(F.xxhash64("id", "signal_timestamp"), F.lit(3))
    rolled = [rollup(bronze.where(part == k), [dispatch], tasks) for k in range(3)]
    merged = merged_parts(reduce(DataFrame.unionAll, rolled), [dispatch])
    return dispatch.from_shares(merged, tasks)


# gold tables


def inventory_visibility(spark: SparkSession, folder: str) -> DataFrame:
    return serving.inventory_visibility(inventory_state(spark, folder))


def demand_forecast(spark: SparkSession, folder: str) -> DataFrame:
    return serving.demand_forecast(demand_drivers(spark, folder))


def dispatch_exposure(spark: SparkSession, folder: str) -> DataFrame:
    return serving.dispatch_exposure(dispatch_context(spark, folder))


def sales_context(spark: SparkSession, folder: str) -> DataFrame:
    return serving.sales_context(demand_forecast(spark, folder))


def planner_explainability(spark: SparkSession, folder: str) -> DataFrame:
    silver = _states(spark, folder, INVENTORY, DEMAND)
    return serving.planner_explainability(silver[INVENTORY], silver[DEMAND])


def _decision_inputs(
    spark: SparkSession, folder: str, wide: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    silver = _states(spark, folder, wide=wide)
    return (
        serving.planner_explainability(silver[INVENTORY], silver[DEMAND]),
        serving.demand_forecast(silver[DEMAND]),
        serving.dispatch_exposure(silver[DISPATCH]),
    )


def _positions(spark: SparkSession, folder: str, wide: bool = False) -> tuple[DataFrame, DataFrame]:
    """Planner rows with their forecast and lanes with their risk, each from one pass over
    the signals."""
    bronze = expect_or_drop(signals_from(spark, folder, BATCH_TAG, wide))
    tasks = line_tasks(spark, folder) if wide else 0  # few groups are aggregated before they are shuffled
    rolled = rollup(bronze, [states.INVENTORY, states.DEMAND], tasks)
    positions = serving.positions_from_rollup(rolled, states.INVENTORY, states.DEMAND, tasks=tasks)
    lanes = states.DISPATCH.from_many(bronze, tasks) if wide else states.dispatch_context(bronze)
    return positions, serving.dispatch_exposure(lanes)


def decisions(spark: SparkSession, folder: str) -> DataFrame:
    return serving.decided(*_positions(spark, folder), as_of=_clock())


def materialized_decisions(spark: SparkSession, folder: str) -> DataFrame:
    """The decision table of a full refresh, in which every table is stored."""
    store = working_store(spark)
    bronze = store.write(BRONZE[0], _bronze(spark, folder))
    return graph.materialize(bronze, store, as_of=_clock())[DECISIONS]


def materialized_after_failure(spark: SparkSession, folder: str) -> DataFrame:
    """The decision table that readers see after a full refresh and a second one, over half
    of the signals, that fails before its last table."""
    store = working_store(spark)
    tables = VersionedTables(spark, f"refresh_{uuid.uuid4().hex}", store.path("tables"))
    bronze = store.write(BRONZE[0], _bronze(spark, folder))
    graph.refresh(bronze, tables, as_of=_clock())
    attempt = tables.begin()
    graph.materialize(_landings(bronze)[0], attempt, as_of=_clock())
    del attempt.written[DECISIONS]
    try:
        tables.publish(attempt)
    except ValueError:
        seen = tables.read(DECISIONS)
    # the plan of the view is resolved by now; the names go, the files stay with the store
    spark.sql(f"DROP DATABASE `{tables.namespace}` CASCADE")
    return seen


def materialized_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Inventory positions with their forecast, from stored tables that are cut into the
    same buckets by market and product, so that they are joined where they lie."""
    store = CatalogStore(spark, f"offers_{uuid.uuid4().hex}")
    planner, forecast, _ = _decision_inputs(spark, folder, wide=True)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, frame in ((PLANNER, planner), (FORECAST, forecast)):
        store.write_bucketed(name, frame, OFFER, buckets)
    found = serving.forecast_positions(store.read(PLANNER), store.read(FORECAST))
    kept = working_store(spark).write("positions", found)
    spark.sql(f"DROP DATABASE `{store.namespace}` CASCADE")
    return kept


def materialized_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """The question about planner decisions of one market, one terminal and one product,
    each over the files of a stored wide table that may hold the answer."""
    planner, _, _ = _decision_inputs(spark, folder, wide=True)
    stored = working_store(spark)
    table = ClusteredTable(spark, stored.path("clustered"), POSITION, files=32)
    table.write(stored.write(PLANNER, planner))
    asked = ({"market_key": ASKED[0]}, {"product_id": ASKED[1]}, {"terminal_id": ASKED_TERMINAL})
    rows = [
        reports.planner_reason(table.read(**one)).withColumn("asked_for", F.lit(next(iter(one)))) for one in asked
    ]
    return reduce(DataFrame.unionAll, rows)


# reports


def decision_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.ranked_summary(serving.decided_counts(*_positions(spark, folder)))


def decision_summary_wide(spark: SparkSession, folder: str) -> DataFrame:
    """The summary where every supplier is a terminal: the pairs it counts grow with the
    square of the suppliers, the work does not."""
    return reports.ranked_summary(serving.decided_counts(*_positions(spark, folder, wide=True)))


def gold_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each gold table, from one rollup and the lanes: a projection has the rows of
    its state, and decisions are counted without building the pairs."""
    bronze = _bronze(spark, folder)
    rolled = bronze.select(*POSITION).distinct()
    lanes = bronze.select(*LANE).distinct()
    offer = F.struct(*OFFER)
    known = F.col("market_key").isNotNull() & F.col("product_id").isNotNull()
    counted = rolled.agg(
        F.count("*").alias(VISIBILITY), F.count_if(known).alias(PLANNER),
        F.count_distinct(offer).alias(FORECAST), F.count_distinct(offer).alias(SALES),
    )
    # every position has as many decisions as its market has lanes, and one without any
    positions = rolled.where(known).groupBy("market_key").agg(F.count("*").alias("positions"))
    routes = lanes.groupBy("market_key").agg(F.count("*").alias("lanes"))
    pairs = F.sum(F.col("positions") * F.coalesce("lanes", F.lit(1)))
    made = positions.join(routes, "market_key", "left").agg(F.coalesce(pairs, F.lit(0)).alias(DECISIONS))
    found = [counted, lanes.agg(F.count("*").alias(EXPOSURE)), made]
    rows = [
        frame.select(F.inline(F.array(*(F.struct(F.lit(c).alias("table_name"), F.col(c).alias("row_count")) for c in frame.columns))))
        for frame in found
    ]
    return reduce(DataFrame.unionAll, rows)


def report_inventory_health(spark: SparkSession, folder: str) -> DataFrame:
    return reports.inventory_health(inventory_visibility(spark, folder))


def report_forecast_trend(spark: SparkSession, folder: str) -> DataFrame:
    return reports.forecast_trend(demand_forecast(spark, folder))


def report_dispatch_risk(spark: SparkSession, folder: str) -> DataFrame:
    return reports.dispatch_risk(dispatch_exposure(spark, folder))


def top_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_forecasts(demand_forecast(spark, folder))


def ask_inventory_by_terminal(spark: SparkSession, folder: str) -> DataFrame:
    return reports.inventory_by_terminal(inventory_visibility(spark, folder))


def ask_planner_reason(spark: SparkSession, folder: str) -> DataFrame:
    """The question for one market and product; its filter reaches the signals."""
    return reports.planner_reason(planner_explainability(spark, folder), *ASKED)


def planner_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return reports.planner_reason(planner_explainability(spark, folder))


def ask_top_markets(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_markets(demand_forecast(spark, folder))


def ask_route_risk(spark: SparkSession, folder: str) -> DataFrame:
    return reports.route_risk(dispatch_exposure(spark, folder))


# publishing


def _reconciled(
    spark: SparkSession, folder: str, shown: Callable[[DataFrame], DataFrame] = lambda frame: frame
) -> DataFrame:
    """Both sides of every gold table. Each is stored once, published once, and counted by
    reading the stored and the published table. ``shown`` changes what is published."""
    gold = graph.gold_tables(_stored_states(spark, folder), as_of=_clock(), store=working_store(spark))
    target = publish.FolderTarget(working_store(spark))
    rows = []
    for name in GOLD:
        target.replace(name, publish.serving_columns(shown(gold[name])))
        rows.append(publish.reconcile(name, gold[name], target, KEYS[name]))
    return reduce(DataFrame.unionAll, rows)


def _stored_states(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    work = working_store(spark)
    plans = graph.planned_states(work.write(BRONZE[0], _bronze(spark, folder)), work)
    return {name: work.write(name, plans[name]) for name in SILVER}


def reconcile_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _reconciled(spark, folder).select("table_name", "source_rows", "target_rows")


def reconcile_keys(spark: SparkSession, folder: str) -> DataFrame:
    return _reconciled(spark, folder).select("table_name", "source_keys", "target_keys", "ok")


def reconcile_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Reconciliation with a copy that lost a market, which every table must show."""
    return _reconciled(spark, folder, lambda frame: frame.where(F.col("market_key") != DRIFTED))


def reconcile_differences(spark: SparkSession, folder: str) -> DataFrame:
    """What differs in a copy that lost a market, renamed another and changed a value of a
    product: the keys of each table, with as many rows and keys as before in the renamed."""
    gold = graph.gold_tables(_stored_states(spark, folder), as_of=_clock(), store=working_store(spark))
    target = publish.FolderTarget(working_store(spark))
    market, found = F.col("market_key"), []
    for name, value in ((VISIBILITY, "demand_units_avg"), (FORECAST, "ai_forecast_units"), (EXPOSURE, "freight_cost_peak")):
        drifted = gold[name].where(market != DRIFTED).withColumns(
            {
                value: F.when(market == ASKED[0], F.col(value) + F.lit(1.0)).otherwise(F.col(value)),
                "market_key": F.when(market == RENAMED[0], RENAMED[1]).otherwise(market),
            }
        )
        target.replace(name, publish.serving_columns(drifted))
        copy = target.store.read(name)
        listed = differences(publish.serving_columns(gold[name]), copy, KEYS[name])
        key = F.concat_ws("/", *KEYS[name]).alias("business_key")
        found.append(listed.select(F.lit(name).alias("table_name"), key, "difference", "source_only", "target_only"))
    return reduce(DataFrame.unionAll, found)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        conform_signals,
        stamped_batch,
        replayed_batch,
        source_lookup,
        bronze_signals,
        expectation_metrics,
        stream_ingest,
        stream_commits,
        stream_repeated_landing,
        incremental_states,
        incremental_dispatch,
        incremental_dispatch_wide,
        raw_signals_by_source,
        signals_by_source,
        inventory_state,
        demand_drivers,
        dispatch_context,
        dispatch_context_wide,
        exact_planner,
        exact_dispatch,
        inventory_visibility,
        planner_explainability,
        demand_forecast,
        dispatch_exposure,
        sales_context,
        decisions,
        materialized_decisions,
        materialized_after_failure,
        materialized_positions,
        materialized_reasons,
        decision_summary,
        decision_summary_wide,
        gold_row_counts,
        report_inventory_health,
        report_forecast_trend,
        report_dispatch_risk,
        top_forecasts,
        ask_inventory_by_terminal,
        ask_planner_reason,
        planner_reasons,
        ask_top_markets,
        ask_route_risk,
        reconcile_counts,
        reconcile_keys,
        reconcile_drift,
        reconcile_differences,
    )
}
