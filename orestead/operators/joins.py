"""Joins of the library: null-tolerant sections, cascades, covers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_with_section(items: DataFrame, directions: DataFrame, keys: list[str], section: str) -> DataFrame:
    """Left join on keys and section, where an item without a section meets every section of its keys."""
    right = directions.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(section).alias("_section"), *[c for c in directions.columns if c not in (*keys, section)])
    on = [F.col(k) == F.col(f"_{k}") for k in keys] + [F.col("_section").eqNullSafe(F.coalesce(F.col(section), F.col("_section")))]
    return items.join(right, on, "left").drop(*[f"_{k}" for k in keys])


def cascade(left: DataFrame, steps: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """The first of several candidate tables (key, value) that has a key decides; the step's name tells which."""
    out, rest = None, left.select(key).distinct()
    for name, table in steps:
        hit = rest.join(table.groupBy(key).agg(F.min("value").alias("value")), key).withColumn("step", F.lit(name))
        out = hit if out is None else out.unionByName(hit)
        rest = rest.join(hit.select(key), key, "left_anti")
    return out.unionByName(rest.select(key, F.lit(None).cast("string").alias("value"), F.lit("none").alias("step")))


def covers(text: Column, keys: Column) -> Column:
    """Whether one of an array of keys is in the text; null text is not applicable (null), no keys means covered."""
    return F.when(text.isNull(), F.lit(None)).when(keys.isNull() | (F.size(keys) == 0), F.lit(True)).otherwise(F.exists(keys, lambda k: F.contains(text, k)))
