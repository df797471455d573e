"""Ordered rule engines compiled to Columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A label for texts that match include and not guard."""

    label: str
    include: str
    guard: str | None = None

    def hit(self, text: Column) -> Column:
        found = text.rlike(self.include)
        return found & ~text.rlike(self.guard) if self.guard else found


def first_rule(text: Column, rules: list[Rule], otherwise: Column | None = None) -> Column:
    """The label of the first rule that hits, as one CASE."""
    out = F.lit(None).cast("string") if otherwise is None else otherwise
    for rule in reversed(rules):
        out = F.when(rule.hit(text), F.lit(rule.label)).otherwise(out)
    return out


def earliest_rule(text: Column, rules: list[Rule]) -> Column:
    """The label whose pattern starts first in the text; ties go to the earlier rule."""
    hits = [F.when(r.hit(text), F.struct(F.regexp_instr(text, F.lit(r.include)).alias("at"), F.lit(i).alias("i"), F.lit(r.label).alias("label"))) for i, r in enumerate(rules)]
    return F.array_min(F.array_compact(F.array(*hits)))["label"]


def classify_distinct(df: DataFrame, keys: list[str], column: str, rule: Column) -> DataFrame:
    """Adds a classification that reads only keys: it runs once for each distinct key and is joined back, nulls included."""
    labelled = df.select(*keys).distinct().select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(k) for k in keys]).withColumn(column, rule).drop(*keys)
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return df.join(labelled, on, "left").drop(*[f"_{k}" for k in keys])
