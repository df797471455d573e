"""Mixing sources to target weights, by DataFrame operations only.

Documents are hashed; a source takes every document a whole number of times and once more those whose
hash is under the source's threshold. The threshold comes from histograms of sizes by source and hash
bucket: the bucket in which the budget ends is refined, and no other, until it holds one hash value.
Nothing is sorted by hash, and budgets nest: a larger budget keeps what a smaller one took.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, materialize, unused

#: Bits of the hash that each histogram resolves, and how often the boundary bucket is refined.
BUCKET_BITS = 12
LEVELS = 4
HASH_BITS = BUCKET_BITS * LEVELS
#: Equal rows that are numbered at once.
COPIES = 4096
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """A row per source: source, source_size, target.

    Sources by code point, null last, have the weights in turn and share `share` times all sizes. A target is
    least(most x size, level x weight); the level at which they add up is found by adding sources in the order in
    which they fill up. These windows see one row per source, not the documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("room", F.col("source_size") * F.lit(float(most)))
    filling = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    per = (
        per.withColumn("fills_at", F.col("room") / F.col("weight"))
        .withColumn("full_before", F.sum("room").over(filling) - F.col("room"))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.sum("weight").over(filling) + F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        # The level if this source were the first that doesn't fill up; the least such place that holds is right.
        .withColumn("level", (F.col("budget") - F.col("full_before")) / F.col("weight_left"))
    )
    level = F.min(F.when(F.col("level") <= F.col("fills_at"), F.struct("fills_at", "level"))).over(everything)["level"]
    per = per.withColumn("water", level)
    return per.select("source", "source_size", F.when(F.col("water").isNull(), F.col("room")).otherwise(F.least(F.col("room"), F.col("water") * F.col("weight"))).alias("target"))


def _thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """A row per source: how often each document is taken, and the hash (low) under which it is taken once more."""
    whole = F.floor(F.col("target") / F.col("source_size")).cast("long")
    state = targets.select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, whole).otherwise(0).alias("times"), F.lit(0).cast("long").alias("low"),
    ).withColumn("left", F.col("target") - F.col("times") * F.col("source_size"))
    for k in range(LEVELS):
        state = materialize(state, f"mix-state{k}")
        shift = HASH_BITS - BUCKET_BITS * (k + 1)
        inside = sizes.join(state.select(F.col("source").alias("s"), "low", "left"), F.col("source").eqNullSafe(F.col("s")))
        if k:
            inside = inside.where(F.shiftright("h", shift + BUCKET_BITS) == F.shiftright("low", shift + BUCKET_BITS))
        hist = inside.groupBy("s", "left", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("w"))
        hist = hist.withColumn("upto", F.sum("w").over(Window.partitionBy("s").orderBy("bucket")))
        fits = F.col("upto") <= F.col("left")
        cut = hist.groupBy("s", "left").agg(
            F.max(F.when(fits, F.struct("bucket", "upto"))).alias("last"), F.min(F.when(~fits, F.struct("bucket", "upto"))).alias("next")
        )
        before = F.coalesce(F.col("last.upto"), F.lit(0))
        # The boundary bucket; past the last bucket if the budget takes all of them.
        bucket = F.coalesce(F.col("next.bucket"), F.col("last.bucket") + 1)
        if k == LEVELS - 1:  # it is one hash value: it goes in if that comes nearer
            nearer = F.col("next.upto") - F.col("left") < F.col("left") - before
            bucket = bucket + F.coalesce(nearer.cast("long"), F.lit(0))
        cut = cut.select(F.col("s").alias("b"), (bucket * F.lit(1 << shift)).alias("new_low"), before.alias("before"))
        state = state.join(cut, F.col("source").eqNullSafe(F.col("b")), "left").select(
            "source", "source_size", "target", "times",
            F.coalesce("new_low", "low").alias("low"), (F.col("left") - F.coalesce("before", F.lit(0))).alias("left"),
        )
    return state


def _hash(seed: int, text_hash: Column, nth: Column) -> Column:
    """HASH_BITS bits from the id, the text's hash and which of the equal rows it is."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", text_hash, nth), 64 - HASH_BITS)


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    """A row per document: doc_id, source, size, k (hash of the text), copies (rows equal to it) and h.

    Equal rows are counted first and then numbered, so that each has a hash of its own and reruns agree.
    """
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("k"))
    counted = rows.groupBy("doc_id", "source", "size", "k").agg(F.count("*").alias("copies"))
    runs = counted.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES))))
    first = F.col("run") * COPIES + 1
    each = runs.withColumn("nth", F.explode(F.sequence(first, F.least("copies", first + (COPIES - 1))))).drop("run")
    return materialize(each.select("doc_id", "source", "size", "k", "copies", _hash(seed, F.col("k"), F.col("nth")).alias("h")), "mix-sizes")


def _cuts(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    targets = source_targets(sizes.select("source", "size"), weights, share, most)
    cuts = materialize(_thresholds(sizes.select("source", "size", "h"), targets), "mix-cuts")
    return cuts.select(F.col("source").alias("s"), "source_size", "target", "times", "low")


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """How often each document is taken so that its source's target size in words is met.

    Returns doc_id, size (words), source_size, target (its source's), taken (words, repeats counted) and times.

    Every document of a source is taken target // source_size times, and once more if its hash is under the
    threshold. The hash is of doc_id, text, seed and a number among equal rows, so reruns agree and equal rows are taken one by one.
    Null text has size 0, null is a source of its own (the last), an empty table gives no rows, and a source without
    words has target 0. Other columns of docs are ignored.
    """
    sizes = _sized(docs, seed)
    cuts = _cuts(sizes, weights, share, most)
    times = F.col("times") + (F.col("h") < F.col("low")).cast("long")
    out = sizes.drop("k", "copies").join(cuts, F.col("source").eqNullSafe(F.col("s")))
    return out.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), (F.col("size") * times).alias("taken"), times.alias("times"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """docs with each row as often as mix_sources takes it.

    Texts aren't shuffled: the cuts, a row per source, are joined to them. Only rows that are equal in doc_id, source and text
    are put together, to be numbered.
    """
    s, t, low, h, copy, k, i, z = unused(docs, "_s", "_t", "_low", "_h", "_copy", "_k", "_i", "_z")
    sizes = _sized(docs, seed)
    cuts = _cuts(sizes, weights, share, most).select(F.col("s").alias(s), F.col("times").alias(t), F.col("low").alias(low))
    times = (F.col(t) + (F.col(h) < F.col(low)).cast("long")).cast("int")
    several = sizes.where("copies > 1").select(F.coalesce("doc_id", F.lit(0)).alias(i), F.col("k").alias(k), F.xxhash64("source", F.col("doc_id").isNull()).alias(z)).distinct()
    keyed = docs.withColumns({i: F.coalesce("doc_id", F.lit(0)), k: F.xxhash64("text"), z: F.xxhash64("source", F.col("doc_id").isNull())})
    number = lambda n: _hash(seed, F.col(k), n)
    if several.isEmpty():
        rows = keyed.withColumn(h, number(F.lit(1).cast("long")))
    else:
        few = F.broadcast(several) if several.count() <= BROADCAST_ROWS else several
        nth = F.row_number().over(Window.partitionBy(i, k, z).orderBy(k)).cast("long")
        rows = keyed.join(few, [i, k, z], "left_anti").withColumn(h, number(F.lit(1).cast("long"))).unionByName(keyed.join(few, [i, k, z], "left_semi").withColumn(h, number(nth)))
    marked = rows.join(cuts, F.col("source").eqNullSafe(F.col(s)))
    return marked.where(times > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), times))).select(*docs.columns)
