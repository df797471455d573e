"""Incremental merges: insert if absent, replace, merge by shard, validated merge, reruns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import first_per


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows win; incoming keys must be distinct."""
    return existing.unionByName(incoming.join(existing.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def replace_on_key(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Incoming rows win; of several incoming rows of a key the last in order (ascending) does. Without an order all of them stay."""
    if order:
        last = Window.partitionBy(*keys).orderBy(*[c.desc() for c in order])
        incoming = incoming.withColumn("_last", F.row_number().over(last)).where("_last = 1").drop("_last")
    return existing.join(incoming.select(*keys).distinct(), keys, "left_anti").unionByName(incoming, allowMissingColumns=True)


def replace_groups(existing: DataFrame, incoming: DataFrame, group: list[str]) -> DataFrame:
    """All rows of a group that comes in are replaced by those that come in."""
    return replace_on_key(existing, incoming, group)


def merge_shard(main: DataFrame, shard: DataFrame, keys: list[str], own: Column, columns: list[str]) -> DataFrame:
    """Takes columns from the shard for rows of its own range; others, and columns that only one side has, stay. Can be repeated."""
    common = [c for c in columns if c in main.columns and c in shard.columns]
    take = shard.where(own).select(*keys, *[F.col(c).alias(f"_{c}") for c in common], F.lit(True).alias("_hit"))
    joined = main.join(take, keys, "left")
    return joined.select(*[F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in common else F.col(c) for c in main.columns])


def sum_by_shard(counters: DataFrame, keys: list[str], shard: str, version: str, value: str) -> DataFrame:
    """Sums shard counters over the last version of each shard, so that merging again doesn't count twice."""
    return first_per(counters, [*keys, shard], [F.desc(version)]).groupBy(*keys).agg(F.sum(value).alias(value))


def split_valid(rows: DataFrame, problems: dict[str, Column]) -> DataFrame:
    """Adds an array of the names of the constraints that a row breaks (null counts as broken)."""
    return rows.withColumn("problems", F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in problems.items()])))


def only_refine(rows: DataFrame, old: str, new: str) -> DataFrame:
    """A new value replaces the old one if it is there and differs; nothing becomes null."""
    changed = F.col(new).isNotNull() & ~F.col(new).eqNullSafe(F.col(old))
    return rows.withColumn("changed", changed).withColumn(old, F.coalesce(new, old))
