"""Order-dependent operators: saturation, running headers, runs, deferrals, first seen, majority and mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row of each key: the first in order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_per(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rn") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def fill_forward(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """The last value seen so far in each group."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))


def islands(df: DataFrame, keys: list[str], order: str, breaks: Column, out: str = "island") -> DataFrame:
    """Numbers runs: a new one starts wherever breaks holds (null counts as a break)."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_cut", F.when(F.coalesce(breaks, F.lit(True)), 1).otherwise(0)).withColumn(out, F.sum("_cut").over(w)).drop("_cut")


def numbered(df: DataFrame, order: list[Column], out: str = "seq", rows_per_task: int = 100_000) -> DataFrame:
    """Numbers rows from 1 in ascending order, without putting them all into one task.

    A sample of the order keys gives the edges of ranges with about rows_per_task rows; rows are numbered within their range, from
    where the counts of the ranges before it end. What reaches the driver are the edges and a count per range.
    """
    total = df.count()
    keyed = df.withColumn("_key", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]))
    ranges = min(-(-total // rows_per_task), 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if ranges <= 1:
        return keyed.withColumn(out, F.row_number().over(Window.orderBy("_key")).cast("long")).drop("_key")
    kinds = keyed.schema["_key"].dataType.fields
    picked = [r["_key"] for r in keyed.sample(min(1.0, 40 * ranges / total), 7).select("_key").orderBy("_key").collect()]
    edges = [picked[len(picked) * i // ranges] for i in range(1, ranges)] if picked else []
    edges = F.array(*[F.struct(*[F.lit(v).cast(k.dataType).alias(k.name) for v, k in zip(e, kinds, strict=True)]) for e in edges])
    placed = keyed.withColumn("_range", F.size(F.filter(edges, lambda e: e <= F.col("_key"))) if picked else F.lit(0))
    return _offset(placed, "_range", F.row_number().over(Window.partitionBy("_range").orderBy("_key")), F.count("*"), out).drop("_key", "_range")


def _offset(df: DataFrame, part: str, inside: Column, amount: Column, out: str) -> DataFrame:
    """inside, a running value within each part, plus the amounts of the parts before it; there are few parts."""
    sums = df.groupBy(part).agg(amount.alias("_n"))
    before = sums.select(F.col(part).alias("_p"), (F.sum("_n").over(Window.orderBy(part)) - F.col("_n")).alias("_before"))
    return df.withColumn("_i", inside).join(F.broadcast(before), F.col(part) == F.col("_p")).withColumn(out, (F.col("_i") + F.col("_before")).cast("long")).drop("_i", "_p", "_before")


def saturation(events: DataFrame, order: str, new: str, total: int, window_min: int = 50, window_share: float = 0.25, earliest_share: float = 0.6, threshold: int = 3, min_list: int = 200, rows_per_task: int = 100_000) -> DataFrame:
    """The first place at which the last window of queries brought fewer than threshold new candidates; null if none did.

    No earlier than earliest_share of the list, and not at all for lists shorter than min_list. Running totals are made
    by ranges of places; a window's sum is the difference of two of them.
    """
    size = max(window_min, int(window_share * total))
    earliest = max(size, int(earliest_share * total))
    rows = numbered(events.select(order, F.col(new).cast("long").alias("new")), [F.col(order)], "seq", rows_per_task).select("seq", "new")
    rows = rows.withColumn("part", F.floor((F.col("seq") - 1) / F.lit(rows_per_task)))
    running = F.sum("new").over(Window.partitionBy("part").orderBy("seq"))
    rows = _offset(rows, "part", running, F.sum("new"), "upto").select("seq", "upto")
    before = rows.select((F.col("seq") + size).alias("seq"), F.col("upto").alias("then"))
    rows = rows.where(F.col("seq") >= earliest).join(before, "seq", "left")
    hit = rows.where((F.col("upto") - F.coalesce("then", F.lit(0)) < threshold) & F.lit(total >= min_list))
    return hit.agg(F.min("seq").alias("at_query")).withColumn("window", F.lit(size))


def majority(df: DataFrame, keys: list[str], label: str, least: int = 5, share: float = 0.6) -> DataFrame:
    """The label that holds at least share of a group's labelled rows and at least `least` of them. Such a label is unique."""
    counts = df.where(F.col(label).isNotNull()).groupBy(*keys, label).agg(F.count("*").alias("n"))
    total = counts.withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
    return total.where((F.col("n") >= least) & (F.col("n") >= F.lit(share) * F.col("total"))).withColumnRenamed(label, "major")


def mode(df: DataFrame, keys: list[str], value: str, position: str) -> DataFrame:
    """The most frequent value; ties go to the one seen first."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(position).alias("first_pos"))
    return first_per(counts, keys, [F.desc("n"), F.col("first_pos"), F.col(value)])


def batches(df: DataFrame, order: list[Column], size: int, rows_per_task: int = 100_000) -> DataFrame:
    """Numbers rows and batches of size in ascending order."""
    return numbered(df, order, "pos", rows_per_task).withColumn("batch", F.floor((F.col("pos") - 1) / F.lit(size)).cast("int"))


def floor_quantiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Per group n, its largest value as top, and for each of shares the value at position min(int(n x share), n - 1), from 0, in order."""
    group = Window.partitionBy(*keys)
    rows = df.select(*keys, value, (F.row_number().over(group.orderBy(value)) - 1).alias("_at"), F.count("*").over(group).alias("_n"))
    place = lambda share: F.least(F.floor(F.col("_n") * F.lit(share)), F.col("_n") - 1)
    picked = [F.max(F.when(F.col("_at") == place(share), F.col(value))).alias(name) for name, share in shares.items()]
    return rows.groupBy(*keys).agg(F.max("_n").alias("n"), *picked, F.max(value).alias("top"))


def spend(df: DataFrame, keys: list[str], order: str, cost: str, limit: Column) -> DataFrame:
    """Charges requests in order while the running total stays within limit: strictly check, then spend."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("used", F.sum(cost).over(w)).withColumn("allowed", F.col("used") <= limit)

