"""Every limit and factor of the rule tables in one place."""

from __future__ import annotations

from dataclasses import dataclass


# The defaults decide the results. All comparisons are strict.
@dataclass(frozen=True)
class Limits:
    # inventory health, in average units
    at_risk_below: float = 500.0
    watch_below: float = 700.0
    # planner reasons and the inventory flag
    pressure_above: float = 0.2
    weather_above: float = 0.6
    # dispatch risk: either measure suffices
    high_exposure_above: float = 1400.0
    high_telematics_above: float = 0.7
    medium_exposure_above: float = 900.0
    medium_telematics_above: float = 0.45
    # freight flag of the decisions, on purpose not one of the risk limits
    freight_above: float = 1100.0
    # sales bands; the upper one is also the surge flag
    growth_above: float = 220.0
    steady_above: float = 170.0
    # forecast
    weather_lift: float = 0.35
    spread_lift: float = 0.08
    base_confidence: float = 0.88
    override_penalty: float = 0.002
    lower_share: float = 0.92
    upper_share: float = 1.08
    horizon_days: int = 7


DEFAULT = Limits()
