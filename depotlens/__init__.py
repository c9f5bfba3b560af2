"""Operational signal analytics as Spark jobs: signals in, decision tables out."""

from depotlens.functions.rules import DEFAULT, Limits
from depotlens.schema import BRONZE, GOLD, KEYS, SIGNALS, SILVER, signal_schema

__all__ = ["BRONZE", "DEFAULT", "GOLD", "KEYS", "Limits", "SIGNALS", "SILVER", "signal_schema"]
