"""The rule tables of the stand-in data. Labels are data: real rule tables are passed to the same operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.rules import Rule, first_rule

DIRECTIONS = [
    Rule("Round", "(ring|rod)", "^old"), Rule("Flat", "plate"), Rule("Toothed", "gear", "small"), Rule("Thermal", "^(hot|cold)"), Rule("Service", "bolt"),
    Rule("Heavy", "anvil", "^new"), Rule("Clever", "gizmo"), Rule("Fitted", "widget", "^(old|blue)"),
]
#: Directions that don't count as clinical.
SERVICE = ("Service",)


def direction(name: Column, section: Column) -> Column:
    """By name, else by section."""
    return first_rule(name, DIRECTIONS, F.when(section == "PROMO", F.lit("Promotion")))
