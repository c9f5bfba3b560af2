"""The three aggregate (silver) states of the signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.operators.measures import Distinct, Hits, Mean, Peak, State
from depotlens.schema import LANE, OFFER, POSITION

CENTS = 100.0  # wholesale cost is in cents, retail price in whole currency units


def _gap() -> Column:
    return F.col("inventory_units_peak") - F.col("inventory_units_avg")


def _spread() -> Column:
    cost = F.col("wholesale_cost_avg") / F.lit(CENTS)
    return F.round(F.col("retail_price_avg") - cost, 3)


def _exposure() -> Column:
    return F.col("freight_cost_peak") * F.col("served_location_count")


INVENTORY = State(
    keys=POSITION,
    measures={
        "as_of_ts": Peak("signal_timestamp"),
        "inventory_units_avg": Mean("inventory_units"),
        "inventory_units_peak": Peak("inventory_units"),
        "warning_signal_count": Hits("warning", lambda: F.col("quality_flag") == "warning"),
        "demand_units_avg": Mean("demand_units"),
        "retail_price_avg": Mean("retail_price"),
        "wholesale_cost_avg": Mean("wholesale_cost"),
        "weather_index_avg": Mean("weather_index"),
    },
    derived={"inventory_gap_units": _gap},
)

DEMAND = State(
    keys=OFFER,
    measures={
        "baseline_demand_units": Mean("demand_units"),
        "weather_index_avg": Mean("weather_index"),
        "retail_price_avg": Mean("retail_price"),
        "wholesale_cost_avg": Mean("wholesale_cost"),
        "planner_override_count": Hits("override", lambda: F.col("planner_override_flag")),
    },
    derived={"price_spread": _spread},
)

DISPATCH = State(
    keys=LANE,
    measures={
        "freight_cost_avg": Mean("freight_cost"),
        "freight_cost_peak": Peak("freight_cost"),
        "telematics_risk_avg": Mean("telematics_risk"),
        "served_location_count": Distinct("retail_location_id"),
    },
    derived={"route_cost_exposure": _exposure},
)

STATES = {
    "silver_inventory_state": INVENTORY,
    "silver_demand_drivers": DEMAND,
    "silver_dispatch_context": DISPATCH,
}

# for stored tables: the same values from run to run, and from signals and from parts
EXACT_STATES = {name: state.exactly() for name, state in STATES.items()}


def inventory_state(signals: DataFrame) -> DataFrame:
    return INVENTORY.from_signals(signals)


def demand_drivers(signals: DataFrame) -> DataFrame:
    return DEMAND.from_signals(signals)


def dispatch_context(signals: DataFrame) -> DataFrame:
    return DISPATCH.from_signals(signals)
