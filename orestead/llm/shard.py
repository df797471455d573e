"""Sharding by a k-d tree over document metadata.

The tree starts with all documents and a number of leaves. A node with k > 1 leaves is split along
its widest metadata dimension at the weighted median: the cut that leaves the share of bytes of
k // 2 leaves on its left. Medians are exact up to one document: every node's histogram over its
dimension's sort key is summed in Spark, and only the bin that holds the cut is refined.
What reaches the driver is nodes x bins sums, which doesn't grow with the data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions

#: Bins of a node's histogram in each refining pass, as a power of two.
BIN_BITS = 12
KEY_BITS = 62
#: The coordinate's part of a sort key; the rest is a hash, so that ties of a dimension can be split.
COORD_BITS = 24
OVERHEAD = 16
#: A cut may be off by this share of a leaf's bytes (or by one document, if that is more).
TOLERANCE = 0.0005
DIMENSIONS = ("size", "doc_id", "lang", "source")


def document_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 16."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(OVERHEAD)


def _unit_hash(c: Column) -> Column:
    """A category's place in [0, 1); null comes first."""
    return F.when(c.isNull(), F.lit(0.0)).otherwise(F.crc32(c.cast("string").cast("binary")) / F.lit(float(2**32)))


def _metadata(docs: DataFrame) -> DataFrame:
    """Ids, sizes and a 62-bit sort key for each dimension."""
    text = F.col("text")
    base = docs.select(
        "doc_id",
        document_size(text).alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        _unit_hash(F.col("lang")).alias("u_lang"),
        _unit_hash(F.col("source")).alias("u_source"),
    )
    return base.withColumn("tie", F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32", "size"), 64 - (KEY_BITS - COORD_BITS)))


def _with_keys(meta: DataFrame) -> DataFrame:
    top = float(2**COORD_BITS - 1)
    span = meta.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.max(F.log2("size")).alias("s"), F.count("*").alias("n"), F.sum("size").alias("w")).first()
    low, high, most = span["a"] or 0, span["b"] or 0, span["s"] or 1.0
    units = {
        "size": F.log2("size") / F.lit(max(most, 1e-9)),
        "doc_id": F.coalesce((F.col("doc_id").cast("double") - F.lit(float(low))) / F.lit(float(max(high - low, 1))), F.lit(0.0)),
        "lang": F.col("u_lang"),
        "source": F.col("u_source"),
    }
    for name, u in units.items():
        coord = F.floor(F.greatest(F.lit(0.0), F.least(u, F.lit(1.0))) * F.lit(top)).cast("long")
        meta = meta.withColumn(f"k_{name}", F.shiftleft(coord, KEY_BITS - COORD_BITS).bitwiseOR(F.col("tie")))
    out = materialize(meta.drop("u_lang", "u_source", "tie"), "kd-meta")
    out._orestead_weight = (span["n"], span["w"] or 0)
    return out


def _per_node(meta: DataFrame, columns: str, rows: list[tuple]) -> DataFrame:
    """A table with a row per tree node: as many as there are leaves at most, so it can be broadcast."""
    values = ", ".join("(" + ", ".join(f"{x}L" if isinstance(x, int) else repr(float(x)) for x in r) + ")" for r in rows)
    return F.broadcast(meta.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(node, {columns})"))


def _key(dim: Column) -> Column:
    return F.get(F.array(*[f"k_{d}" for d in DIMENSIONS]), dim.cast("int"))


def _descend(at: DataFrame, splits: dict[int, tuple[int, int]]) -> DataFrame:
    """One level down; node n has the children 2n + 1 and 2n + 2. splits: dimension and cut of each node that is split."""
    table = _per_node(at, "dim, cut", [(n, *x) for n, x in splits.items()])
    below = F.col("node") * 2 + 1 + (_key(F.col("dim")) >= F.col("cut")).cast("long")
    return at.join(table, "node", "left").withColumn("node", F.when(F.col("dim").isNull(), F.col("node")).otherwise(below)).drop("dim", "cut")


def _cuts(meta: DataFrame, todo: dict[int, tuple[int, float, float]]) -> dict[int, int]:
    """For each node (its dimension, the weight wanted on its left, the weight that may be off): the key to cut at.

    Each pass sums weights in 2**12 bins of the range that still holds the cut, for all nodes in one job.
    """
    state = {n: {"dim": d, "want": w, "slack": t, "lo": 0, "bits": KEY_BITS} for n, (d, w, t) in todo.items()}
    done: dict[int, int] = {}
    while state:
        table = _per_node(meta, "dim, lo, shift, top", [(n, s["dim"], s["lo"], max(0, s["bits"] - BIN_BITS), (1 << s["bits"]) - 1) for n, s in state.items()])
        hist = (
            meta.join(table, "node")
            .select("node", "size", "shift", (_key(F.col("dim")) - F.col("lo")).alias("at"), "top")
            .where((F.col("at") >= 0) & (F.col("at") <= F.col("top")))
            .groupBy("node", F.expr("shiftright(at, cast(shift as int))").alias("bin"))
            .agg(F.sum("size").alias("w"), F.count("*").alias("n"))
            .collect()
        )
        bins: dict[int, list[tuple[int, int, int]]] = {n: [] for n in state}
        for r in hist:
            bins[r["node"]].append((r["bin"], r["w"], r["n"]))
        for n in list(state):
            s = state[n]
            width, below = max(0, s["bits"] - BIN_BITS), 0.0
            cut, inner = s["lo"], None
            for b, w, count in sorted(bins[n]):
                if below + w <= s["want"]:
                    below += w
                    cut = s["lo"] + ((b + 1) << width)
                    continue
                if count > 1 and width > 0 and w > s["slack"]:
                    inner = (s["lo"] + (b << width), s["want"] - below)
                else:  # one document, or equal keys: it goes to the nearer side
                    cut = s["lo"] + ((b + (s["want"] - below > w / 2)) << width)
                break
            if inner is None:
                done[n] = cut
                del state[n]
            else:
                s["lo"], s["want"], s["bits"] = inner[0], inner[1], width
    return done


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """Puts every document into one of `shards` shards of nearly equal bytes (law `bytes`).

    Give the number of leaves, or target_bytes: leaves are then split until none has much more.
    Returns doc_id, size (UTF-8 bytes + 16), text_crc32, law, shard (from 0), slot (gapless from 0
    within its shard) and grown_shard (null: only the law `key` has it).

    Null text has size 16 and CRC 0. Nulls of lang, source and doc_id have a place of their own (first).
    Equal rows, ties and a source with any share of the rows are split by a hash of doc_id and text;
    only rows equal in doc_id, size and text can't be told apart and stay together. An empty table gives
    no rows. Further columns of docs are ignored.
    """
    for c in ("lang", "source"):
        if c not in docs.columns:
            docs = docs.withColumn(c, F.lit(None).cast("string"))
    meta = _with_keys(_metadata(docs))
    rows, weight = meta._orestead_weight
    if shards is None:
        shards = max(1, math.ceil(weight / (target_bytes or 1 << 30)))
    slack = TOLERANCE * weight / shards
    at = meta.withColumn("node", F.lit(0).cast("long"))
    leaves, open_nodes = {0: shards}, [0] if shards > 1 and rows else []
    while open_nodes:
        extent = (
            at.where(F.col("node").isin(open_nodes)).groupBy("node")
            .agg(F.sum("size").alias("w"), *[(F.max(f"k_{d}") - F.min(f"k_{d}")).alias(d) for d in DIMENSIONS])
            .collect()
        )
        todo = {}
        for r in extent:
            k = leaves[r["node"]]
            widest = max(range(len(DIMENSIONS)), key=lambda i: (r[DIMENSIONS[i]], i))
            todo[r["node"]] = (widest, r["w"] * (k // 2) / k, slack)
        cuts = _cuts(at, todo)
        at = _descend(at, {n: (todo[n][0], cuts[n]) if n in todo else (0, 0) for n in open_nodes})
        following = []
        for n in open_nodes:
            k = leaves.pop(n)
            leaves[2 * n + 1], leaves[2 * n + 2] = k // 2, k - k // 2
            following += [x for x in (2 * n + 1, 2 * n + 2) if leaves[x] > 1]
        open_nodes = following
    placed = at.join(_per_node(at, "shard", list(zip(sorted(leaves), range(shards)))), "node").select("doc_id", "size", "text_crc32", "shard")
    return _slots(placed).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _slots(placed: DataFrame) -> DataFrame:
    """Gapless numbers within each shard, without putting a shard into one task: counts by (shard, salt) give each salt its first number."""
    salts = shuffle_partitions(placed.sparkSession)
    placed = placed.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(salts)).cast("int"))
    counts = placed.groupBy("shard", "salt").agg(F.count("*").alias("n"))
    first = counts.select(
        "shard", "salt", (F.sum("n").over(Window.partitionBy("shard").orderBy("salt")) - F.col("n")).alias("base")
    )
    inside = Window.partitionBy("shard", "salt").orderBy("doc_id", "text_crc32", "size")
    return (
        placed.withColumn("i", F.row_number().over(inside) - 1)
        .join(first, ["shard", "salt"])
        .withColumn("slot", (F.col("base") + F.col("i")).cast("long"))
    )
