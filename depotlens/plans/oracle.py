"""DuckDB texts that answer the registered queries independently.

Doubles are rounded through their shortest decimal text, as Spark does; a plain
``round`` decides ties by the binary value. Literals are cast to DOUBLE, since a
bare ``0.35`` is a DECIMAL there."""

from __future__ import annotations

import re
from datetime import timedelta

from depotlens.functions.scalars import IDS_PER_MILLISECOND
from depotlens.plans.registry import AS_OF, ASKED, ASKED_TERMINAL, BATCH_TAG, DRIFTED, LANDING_GAP_MS, RENAMED, REPLAY_HOURS
from depotlens.schema import GOLD, KEYS, SOURCE_SYSTEMS


def _rounded(value: str, digits: int, kind: str = "DOUBLE") -> str:
    return f"CAST(ROUND(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS {kind})"


def _d(number: str) -> str:
    return f"CAST({number} AS DOUBLE)"


def _source_case(index: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(SOURCE_SYSTEMS[:-1]))
    return f"CASE {index} {arms} ELSE '{SOURCE_SYSTEMS[-1]}' END"


def _padded(number: str, width: int) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"CASE WHEN length({text}) >= {width} THEN {text} ELSE lpad({text}, {width}, '0') END"


_MEASURES = {
    "inventory_units": f"{_d('350 + (l_partkey % 8) * 60')} + l_quantity * 4",
    "demand_units": f"{_d('120 + c_nationkey * 3')} + l_quantity",
    "wholesale_cost": _d("150 + l_linenumber * 5"),
    "retail_price": f"3 + {_d('l_suppkey % 32')} / {_d('64')}",
    "weather_index": f"{_d('(c_nationkey % 5) * 12 + l_linenumber')} / {_d('64')}",
    "freight_cost": f"""CASE WHEN l_orderkey % 5 = 4 THEN NULL
         ELSE {_d('25 + (l_orderkey % 5) * 25')} + l_quantity / {_d('2')} END""",
    "telematics_risk": f"{_d('(l_suppkey % 6) * 10 + l_linenumber')} / {_d('64')}",
}
_KEPT = f"l_extendedprice * ({_d('1')} - l_discount)"
_PRICES = {
    "inventory_units": "l_extendedprice * l_discount",
    "demand_units": "l_extendedprice * l_tax",
    "wholesale_cost": _KEPT,
    "retail_price": f"{_KEPT} * ({_d('1')} + l_tax) / {_d('100')}",
    "weather_index": f"l_discount * l_tax * {_d('99')}",
    "freight_cost": "CASE WHEN l_orderkey % 5 <> 4 THEN l_extendedprice * l_discount * l_tax END",
    "telematics_risk": f"l_discount / ({_d('1')} + l_tax)",
}


def _signals(
    terminal: str = "l_suppkey % 6", location: str = "o_custkey % 12", measures: dict[str, str] = _MEASURES
) -> str:
    listed = "".join(f"    {text} AS {name},\n" for name, text in measures.items())
    return f"""signals AS (
  SELECT
    l_orderkey * 8 + l_linenumber AS id,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE {_source_case('l_orderkey % 12')} END AS source_system,
    l_shipdate AS signal_timestamp,
    'MKT-' || {_padded('c_nationkey', 2)} AS market_key,
    'TRM-' || {_padded(terminal, 3)} AS terminal_id,
    'PRD-' || {_padded('l_partkey % 8', 2)} AS product_id,
    'RTE-' || {_padded('l_orderkey % 5', 3)} AS route_id,
    'LOC-' || {_padded(location, 4)} AS retail_location_id,
{listed}    l_returnflag = 'R' AS planner_override_flag,
    'SRC-{BATCH_TAG}-' || CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) AS source_record_id,
    'BATCH-{BATCH_TAG}' AS ingest_batch_id,
    CASE WHEN l_linenumber = 7 THEN 'warning' ELSE 'ok' END AS quality_flag,
    o_orderdate AS record_created_ts
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
)"""

BRONZE = "bronze AS (SELECT * FROM signals WHERE source_system IS NOT NULL)"

INVENTORY = """inventory AS (
  SELECT *, inventory_units_peak - inventory_units_avg AS inventory_gap_units FROM (
    SELECT market_key, terminal_id, product_id,
      MAX(signal_timestamp) AS as_of_ts,
      AVG(inventory_units) AS inventory_units_avg,
      MAX(inventory_units) AS inventory_units_peak,
      CAST(SUM(CASE WHEN quality_flag = 'warning' THEN 1 ELSE 0 END) AS BIGINT) AS warning_signal_count,
      AVG(demand_units) AS demand_units_avg,
      AVG(retail_price) AS retail_price_avg,
      AVG(wholesale_cost) AS wholesale_cost_avg,
      AVG(weather_index) AS weather_index_avg
    FROM bronze GROUP BY market_key, terminal_id, product_id))"""

DEMAND = f"""demand AS (
  SELECT *, {_rounded("retail_price_avg - wholesale_cost_avg / CAST(100 AS DOUBLE)", 3)} AS price_spread FROM (
    SELECT market_key, product_id,
      AVG(demand_units) AS baseline_demand_units,
      AVG(weather_index) AS weather_index_avg,
      AVG(retail_price) AS retail_price_avg,
      AVG(wholesale_cost) AS wholesale_cost_avg,
      CAST(SUM(CASE WHEN planner_override_flag THEN 1 ELSE 0 END) AS BIGINT) AS planner_override_count
    FROM bronze GROUP BY market_key, product_id))"""

DISPATCH = """dispatch AS (
  SELECT *, freight_cost_peak * served_location_count AS route_cost_exposure FROM (
    SELECT route_id, market_key, terminal_id,
      AVG(freight_cost) AS freight_cost_avg,
      MAX(freight_cost) AS freight_cost_peak,
      AVG(telematics_risk) AS telematics_risk_avg,
      COUNT(DISTINCT retail_location_id) AS served_location_count
    FROM bronze GROUP BY route_id, market_key, terminal_id))"""

VISIBILITY = f"""visibility AS (
  SELECT *,
    CASE WHEN inventory_units_avg < 500 THEN 'at_risk'
         WHEN inventory_units_avg < 700 THEN 'watch' ELSE 'healthy' END AS inventory_health,
    {_rounded("demand_units_avg / NULLIF(inventory_units_avg, 0)", 4)} AS inventory_utilization_ratio
  FROM inventory)"""

PLANNER = f"""planner AS (
  SELECT *,
    CASE WHEN inventory_pressure_score > {_d('0.2')} THEN 'inventory_variability'
         WHEN weather_pressure_score > {_d('0.6')} THEN 'weather_shift'
         ELSE 'stable_signal' END AS planner_reason_code
  FROM (
    SELECT i.market_key, i.product_id, i.terminal_id, i.as_of_ts, i.inventory_units_avg,
      i.inventory_units_peak, i.warning_signal_count, i.demand_units_avg, i.retail_price_avg,
      i.wholesale_cost_avg, i.inventory_gap_units, d.baseline_demand_units, d.weather_index_avg,
      d.price_spread, d.planner_override_count,
      {_rounded("i.inventory_gap_units / NULLIF(i.inventory_units_avg, 0)", 4)} AS inventory_pressure_score,
      {_rounded("d.weather_index_avg", 4)} AS weather_pressure_score
    FROM inventory i
    JOIN demand d ON i.market_key = d.market_key AND i.product_id = d.product_id))"""

_LIFTED = (
    f"baseline_demand_units * ({_d('1')} + weather_index_avg * {_d('0.35')})"
    f" * ({_d('1')} + price_spread * {_d('0.08')})"
)

FORECAST = f"""forecast AS (
  SELECT *,
    {_rounded(f"ai_forecast_units * {_d('0.92')}", 2)} AS forecast_lower_bound,
    {_rounded(f"ai_forecast_units * {_d('1.08')}", 2)} AS forecast_upper_bound,
    7 AS forecast_horizon_days
  FROM (
    SELECT *,
      {_rounded(_LIFTED, 2)} AS ai_forecast_units,
      {_rounded(f"{_d('0.88')} - planner_override_count * {_d('0.002')}", 3)} AS forecast_confidence
    FROM demand))"""

EXPOSURE = f"""exposure AS (
  SELECT *,
    CASE WHEN route_cost_exposure > 1400 OR telematics_risk_avg > {_d('0.7')} THEN 'high'
         WHEN route_cost_exposure > 900 OR telematics_risk_avg > {_d('0.45')} THEN 'medium'
         ELSE 'low' END AS dispatch_risk_level
  FROM dispatch)"""

SALES = """sales AS (
  SELECT market_key, product_id, ai_forecast_units, forecast_confidence, forecast_horizon_days,
    price_spread, weather_index_avg,
    CASE WHEN ai_forecast_units > 220 THEN 'growth_opportunity'
         WHEN ai_forecast_units > 170 THEN 'steady_state'
         ELSE 'demand_watch' END AS sales_priority_band
  FROM forecast)"""

DECIDED = f"""decided AS (
  SELECT *,
    CASE WHEN inventory_risk_flag AND demand_surge_flag THEN 'increase_terminal_replenishment'
         WHEN freight_risk_flag THEN 'reroute_dispatch'
         WHEN dispatch_risk_level = 'high' THEN 'escalate_dispatch_review'
         ELSE 'maintain_current_plan' END AS ai_query_action,
    CASE WHEN inventory_risk_flag AND demand_surge_flag THEN 'inventory_gap_with_demand_surge'
         WHEN freight_risk_flag THEN 'route_cost_threshold'
         WHEN dispatch_risk_level = 'high' THEN 'telematics_and_dispatch_risk'
         ELSE 'criteria_within_tolerance' END AS ai_query_reason_code,
    TIMESTAMP '{AS_OF}' AS decision_timestamp
  FROM (
    SELECT p.*, f.ai_forecast_units, f.forecast_confidence,
      COALESCE(e.route_cost_exposure, {_d('0')}) AS route_cost_exposure,
      COALESCE(e.dispatch_risk_level, 'low') AS dispatch_risk_level,
      p.inventory_pressure_score > {_d('0.2')} AS inventory_risk_flag,
      f.ai_forecast_units > 220 AS demand_surge_flag,
      COALESCE(e.route_cost_exposure, {_d('0')}) > 1100 AS freight_risk_flag
    FROM planner p
    JOIN forecast f ON p.market_key = f.market_key AND p.product_id = f.product_id
    LEFT JOIN exposure e ON p.market_key = e.market_key))"""

PARTS = (
    BRONZE, INVENTORY, DEMAND, DISPATCH,
    VISIBILITY, PLANNER, FORECAST, EXPOSURE, SALES, DECIDED,
)


def _over(body: str, signals: str = _signals()) -> str:
    return "WITH " + ",\n".join((signals, *PARTS)) + "\n" + body


_GOLD_VIEWS = dict(
    zip(GOLD, ("visibility", "planner", "forecast", "exposure", "sales", "decided"), strict=True)
)


def _per_gold_table(columns: str) -> str:
    """One row per gold table; ``{rows}`` and ``{keys}`` stand for its two counts, the
    others for those of a copy without one market."""
    selects = []
    for name, view in _GOLD_VIEWS.items():
        counts = {}
        for prefix, rows in (("", view), ("left_", f"(SELECT * FROM {view} WHERE market_key <> '{DRIFTED}')")):
            distinct = f"(SELECT DISTINCT {', '.join(KEYS[name])} FROM {rows})"
            counts[f"{prefix}rows"] = f"(SELECT COUNT(*) FROM {rows})"
            counts[f"{prefix}keys"] = f"(SELECT COUNT(*) FROM {distinct})"
        selects.append(f"SELECT '{name}' AS table_name, " + columns.format(**counts))
    return _over("\nUNION ALL\n".join(selects))


_WIDE = _signals("l_suppkey", "o_custkey")
_PRICED, _PRICED_WIDE = _signals(measures=_PRICES), _signals("l_suppkey", "o_custkey", _PRICES)

# a sum of doubles as one of integers, which is exact, rounded once by way of its text
_EXACT = (
    r"CAST(CAST(SUM(CAST(trunc(\1 * pow(CAST(2 AS DOUBLE), 62)) AS HUGEINT)) AS VARCHAR) AS DOUBLE)"
    r" / pow(CAST(2 AS DOUBLE), 62) / COUNT(\1)"
)


def _exactly(text: str) -> str:
    return re.sub(r"AVG\((\w+)\)", _EXACT, text)


_SUMMARY = """SELECT ai_query_action, ai_query_reason_code, COUNT(*) AS decision_count FROM decided
GROUP BY ai_query_action, ai_query_reason_code
ORDER BY decision_count DESC, ai_query_action, ai_query_reason_code"""
# the join alone; a wide decision table is too large to build
_WIDE_SUMMARY = """SELECT ai_query_action, ai_query_reason_code, CAST(SUM(n) AS BIGINT) AS decision_count FROM (
  SELECT p.n * coalesce(e.n, 1) AS n,
    CASE WHEN replenish THEN 'increase_terminal_replenishment' WHEN freight THEN 'reroute_dispatch'
         WHEN high THEN 'escalate_dispatch_review' ELSE 'maintain_current_plan' END AS ai_query_action,
    CASE WHEN replenish THEN 'inventory_gap_with_demand_surge' WHEN freight THEN 'route_cost_threshold'
         WHEN high THEN 'telematics_and_dispatch_risk' ELSE 'criteria_within_tolerance' END AS ai_query_reason_code
  FROM (
    SELECT market_key, COUNT(*) AS n,
      coalesce(inventory_pressure_score > CAST(0.2 AS DOUBLE) AND ai_forecast_units > 220, FALSE) AS replenish
    FROM planner JOIN forecast USING (market_key, product_id) GROUP BY ALL) p
  LEFT JOIN (
    SELECT market_key, COUNT(*) AS n, coalesce(route_cost_exposure, 0) > 1100 AS freight,
      dispatch_risk_level = 'high' AS high
    FROM exposure GROUP BY ALL) e USING (market_key))
GROUP BY ALL ORDER BY decision_count DESC, ai_query_action, ai_query_reason_code"""
_BY_SOURCE = (
    "SELECT source_system, COUNT(*) AS row_count FROM {} GROUP BY source_system"
    " ORDER BY source_system NULLS FIRST"
)
_REASONS = """SELECT market_key, product_id, terminal_id, inventory_pressure_score,
  weather_pressure_score, price_spread, planner_override_count, planner_reason_code FROM planner"""
_LATER = (AS_OF + timedelta(milliseconds=LANDING_GAP_MS)).strftime("%Y%m%d%H%M%S")
_DECISIONS = _over("SELECT * FROM decided")
_STAMP = AS_OF.strftime("%Y%m%d%H%M%S")



def _difference(name: str, value: str) -> str:
    """Rows of one side only, by key, of a table and its drifted copy."""
    view, keys = _GOLD_VIEWS[name], ", ".join(KEYS[name])
    copy = f"""SELECT * REPLACE (
      CASE WHEN market_key = '{ASKED[0]}' THEN {value} + 1 ELSE {value} END AS {value},
      CASE WHEN market_key = '{RENAMED[0]}' THEN '{RENAMED[1]}' ELSE market_key END AS market_key)
    FROM {view} WHERE market_key <> '{DRIFTED}'"""
    return f"""SELECT '{name}' AS table_name, concat_ws('/', {keys}) AS business_key,
  CASE WHEN target_only = 0 THEN 'lost' WHEN source_only = 0 THEN 'added' ELSE 'changed' END AS difference, source_only, target_only
FROM (SELECT {keys}, COUNT(*) FILTER (here) AS source_only, COUNT(*) FILTER (NOT here) AS target_only FROM (
  SELECT *, TRUE AS here FROM (SELECT * FROM {view} EXCEPT ALL {copy})
  UNION ALL SELECT *, FALSE FROM ({copy} EXCEPT ALL SELECT * FROM {view})) GROUP BY ALL)"""


_DIFFERENCES = "\nUNION ALL\n".join(
    _difference(GOLD[k], value) for k, value in ((0, "demand_units_avg"), (2, "ai_forecast_units"), (3, "freight_cost_peak"))
)

ORACLE: dict[str, str] = {
    "conform_signals": _over("SELECT * FROM signals"),
    "stamped_batch": _over(
        f"""SELECT id + (id % 2) * {LANDING_GAP_MS * IDS_PER_MILLISECOND} AS id_since_start,
  'SRC-{BATCH_TAG}-' || CAST(id AS VARCHAR) AS source_record_id,
  'BATCH-{BATCH_TAG}-' || CASE WHEN id % 2 = 0 THEN '{_STAMP}' ELSE '{_LATER}' END AS ingest_batch_id,
  TIMESTAMP '{AS_OF}' + to_milliseconds((id % 2) * {LANDING_GAP_MS}) AS record_created_ts
FROM signals"""
    ),
    "replayed_batch": _over(
        f"""SELECT market_key, TIMESTAMP '{AS_OF}' - to_hours(id % {REPLAY_HOURS}) AS signal_timestamp, COUNT(*) AS row_count
FROM signals GROUP BY ALL"""
    ),
    "source_lookup": (
        f"SELECT o_orderkey, {_source_case('o_orderkey % 17 - 2')} AS source_system FROM orders"
    ),
    "bronze_signals": _over("SELECT * FROM bronze"),
    "expectation_metrics": _over(
        """SELECT 'valid_source_system' AS expectation,
  COUNT(source_system) AS passed, COUNT(*) - COUNT(source_system) AS failed FROM signals"""
    ),
    "stream_ingest": _over("SELECT *, COUNT(*) OVER (PARTITION BY id % 2) AS passed_in_run FROM bronze"),
    "stream_commits": _over("SELECT * REPLACE (ingest_batch_id || '-' || CAST(id % 2 AS VARCHAR) AS ingest_batch_id) FROM bronze"),
    "stream_repeated_landing": _over(
        "SELECT * REPLACE (ingest_batch_id || '-' || CAST(id % 2 AS VARCHAR) AS ingest_batch_id),"
        " COUNT(*) OVER (PARTITION BY id % 2) AS rows_in_ledger FROM signals"
    ),
    "incremental_states": _over("SELECT * FROM planner"),
    "incremental_dispatch": _over("SELECT * FROM dispatch"),
    "incremental_dispatch_wide": _over("SELECT * FROM dispatch", _WIDE),
    "raw_signals_by_source": _over(_BY_SOURCE.format("signals")),
    "signals_by_source": _over(_BY_SOURCE.format("bronze")),
    "inventory_state": _over("SELECT * FROM inventory"),
    "demand_drivers": _over("SELECT * FROM demand"),
    "dispatch_context": _over("SELECT * FROM dispatch"),
    "dispatch_context_wide": _over("SELECT * FROM dispatch", _WIDE),
    "exact_planner": _exactly(_over("SELECT * FROM planner", _PRICED)),
    "exact_dispatch": _exactly(_over("SELECT * FROM dispatch", _PRICED_WIDE)),
    "inventory_visibility": _over("SELECT * FROM visibility"),
    "planner_explainability": _over("SELECT * FROM planner"),
    "demand_forecast": _over("SELECT * FROM forecast"),
    "dispatch_exposure": _over("SELECT * FROM exposure"),
    "sales_context": _over("SELECT * FROM sales"),
    "decisions": _DECISIONS,
    "materialized_decisions": _DECISIONS,
    "materialized_after_failure": _DECISIONS,
    "materialized_positions": _over(
        "SELECT p.*, ai_forecast_units, forecast_confidence FROM planner p JOIN forecast USING (market_key, product_id)", _WIDE
    ),
    "materialized_reasons": _over(
        "\nUNION ALL\n".join(
            f"SELECT *, '{column}' AS asked_for FROM ({_REASONS}) WHERE {column} = '{value}'"
            for column, value in (("market_key", ASKED[0]), ("product_id", ASKED[1]), ("terminal_id", ASKED_TERMINAL))
        ),
        _WIDE,
    ),
    "decision_summary": _over(_SUMMARY),
    "decision_summary_wide": _over(_WIDE_SUMMARY, _WIDE),
    "gold_row_counts": _per_gold_table("{rows} AS row_count"),
    "report_inventory_health": _over(
        """SELECT market_key, terminal_id, product_id, inventory_health, inventory_units_avg,
  demand_units_avg, inventory_utilization_ratio FROM visibility
ORDER BY inventory_utilization_ratio DESC NULLS LAST, market_key, terminal_id, product_id LIMIT 200"""
    ),
    "report_forecast_trend": _over(
        """SELECT market_key, product_id, ai_forecast_units, forecast_confidence,
  forecast_lower_bound, forecast_upper_bound FROM forecast
ORDER BY ai_forecast_units DESC NULLS LAST, market_key, product_id LIMIT 200"""
    ),
    "report_dispatch_risk": _over(
        """SELECT market_key, route_id, dispatch_risk_level, route_cost_exposure,
  freight_cost_avg, telematics_risk_avg FROM exposure
ORDER BY route_cost_exposure DESC NULLS LAST, route_id, market_key, terminal_id LIMIT 200"""
    ),
    "top_forecasts": _over(
        """SELECT market_key, product_id, ai_forecast_units, forecast_confidence FROM forecast
ORDER BY ai_forecast_units DESC NULLS LAST, market_key, product_id LIMIT 20"""
    ),
    "ask_inventory_by_terminal": _over(
        f"""SELECT market_key, terminal_id,
  CAST(SUM({_rounded("inventory_units_avg", 6, "DECIMAL(18,6)")}) AS DOUBLE) AS inventory_units,
  MAX(as_of_ts) AS as_of_ts,
  COUNT(*) FILTER (WHERE inventory_health = 'at_risk') AS at_risk_products
FROM visibility GROUP BY market_key, terminal_id"""
    ),
    "ask_planner_reason": _over(
        f"{_REASONS} WHERE market_key = '{ASKED[0]}' AND product_id = '{ASKED[1]}'"
    ),
    "planner_reasons": _over(_REASONS),
    "ask_top_markets": _over(
        f"""SELECT market_key,
  CAST(SUM({_rounded("ai_forecast_units", 2, "DECIMAL(18,2)")}) AS DOUBLE) AS forecast_units
FROM forecast GROUP BY market_key ORDER BY forecast_units DESC NULLS LAST, market_key"""
    ),
    "ask_route_risk": _over(
        """SELECT route_id, MAX(route_cost_exposure) AS route_cost_exposure_peak,
  COUNT(*) FILTER (WHERE dispatch_risk_level = 'high') AS high_risk_lanes
FROM exposure GROUP BY route_id ORDER BY route_cost_exposure_peak DESC NULLS LAST, route_id"""
    ),
    "reconcile_counts": _per_gold_table("{rows} AS source_rows, {rows} AS target_rows"),
    "reconcile_keys": _per_gold_table(
        "{keys} AS source_keys, {keys} AS target_keys, TRUE AS ok"
    ),
    "reconcile_drift": _per_gold_table(
        "{rows} AS source_rows, {left_rows} AS target_rows, {keys} AS source_keys,"
        " {left_keys} AS target_keys, {rows} = {left_rows} AND {keys} = {left_keys} AS ok"
    ),
    "reconcile_differences": _over(_DIFFERENCES),
}
