"""MinHash near-duplicates by tensored banding.

Two collections of HALVES half keys of ROWS minhashes each are computed; a table's key is a pair of one half key of
either collection, so 2 x HALVES x ROWS minhashes serve HALVES**2 tables. Documents that share a key are candidates.

Candidates aren't expanded to all pairs of a bucket. Sets that are equal are one class from the start. In each
bucket the members are compared with one centre, the one that meets the most sets over all tables; linked members join
its component, and only what is still in different components of one bucket goes on: to a few members of the largest
component there, to the middle one of its members as those few show it, and in the end to an exact prefix filter over
the rarest shingles. So every candidate pair is in one component already, or compared on full sets, or cannot be
similar enough, whatever the size of a group of copies or the number of texts around one common passage.

At similarity s a pair misses all tables with probability 1 - (1 - (1 - s**ROWS)**HALVES)**2: 7e-5 at 0.85, 3e-6 at 0.9.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Words, discard, grams, in_arrow, int_lists, materialize, mix, text_blocks
from .components import components

ROWS, HALVES = 2, 8
#: Members by which a component's middle is found. Comparing with middles goes on while it links this part of the pairs.
REFERENCES, SETTLED = 3, 0.1
#: Bands of set sizes to a doubling.
BANDS = 96
#: Counters of the sketch of shingle frequencies; any size is right, more of them make rarer keys.
SKETCH = 1 << 18


def _shingles(words: Words, i: int, windows: np.ndarray, k: int) -> np.ndarray:
    lo, hi = words.bound[i], words.bound[i + 1]
    if hi - lo >= k:
        return np.unique(windows[lo : hi - k + 1])
    if hi == lo:
        return np.zeros(0, dtype=np.uint64)
    return grams(words.hash[lo:hi], int(hi - lo))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct k-word shingles of one text."""
    raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
    words = Words(raw, np.array([0, len(raw)]), lower=True)
    return _shingles(words, 0, grams(words.hash, k), k)


def _sketcher(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_hashes = 2 * ROWS * HALVES
        odd = mix(np.arange(n_hashes, dtype=np.uint64) + np.uint64(99)) | np.uint64(1)
        tables = np.arange(2 * HALVES, dtype=np.uint64)
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column("text")):
                words = Words(data, offsets, lower=True)
                windows = grams(words.hash, k)
                n = hi - lo
                size, h1, h2 = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                halves = np.zeros((n, 2 * HALVES), dtype=np.uint64)
                for i in range(n):
                    u = _shingles(words, i, windows, k)
                    if len(u):
                        size[i], h1[i], h2[i] = len(u), mix(u).sum(), mix(u ^ np.uint64(0x5DEECE66D)).sum()
                        low = np.full(n_hashes, np.iinfo(np.uint64).max, dtype=np.uint64)
                        for at in range(0, len(u), 4096):
                            np.minimum(low, (u[at : at + 4096, None] * odd).min(axis=0), out=low)
                        low = mix(low)
                        acc = tables.copy()
                        for r in range(ROWS):
                            acc = mix(acc + low[r::ROWS])
                        halves[i] = acc
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, n), batch.column("text_hash").slice(lo, n), pa.array(size), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), int_lists(halves.view(np.int64).ravel(), np.arange(n + 1) * 2 * HALVES)],
                    names=["doc_id", "text_hash", "n_shingles", "h1", "h2", "halves"],
                )

    return run


def _verifier(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_id, last = None, None
        for batch in batches:
            a, b = batch.column("a"), batch.column("b")
            ta, tb = batch.column("text_a"), batch.column("text_b")
            keep, alike = [], []
            for i in range(len(a)):
                key = a[i].as_py()
                if key != last_id:
                    last_id, last = key, shingle_set(ta[i].as_py(), k)
                other = shingle_set(tb[i].as_py(), k)
                small, large = sorted((len(last), len(other)))
                both = 0 if 100 * small < percent * large else len(np.intersect1d(last, other, assume_unique=True))
                keep.append(100 * both >= percent * (small + large - both) and both > 0)
                alike.append(both / max(small + large - both, 1))
            yield pa.RecordBatch.from_arrays([a, b, pa.array(keep, pa.bool_()), pa.array(alike, pa.float64())], names=["a", "b", "linked", "alike"])

    return run


def _prefix_pairs(rows: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b): pairs of rows (node, component, text) in different components that can reach the similarity.

    Exact prefix filter: with shingles in one order, rarest first, two sets that are similar enough share one of their
    first shingles, so early in both that what follows can still suffice. A pair meets as the smaller and the larger
    set: the smaller one's place must suffice for a partner of its own size; the larger one names, for each of its
    first shingles, the bands of sizes for which that place suffices. So sets around one common text meet only where a
    pair could be similar enough. A band is named only where a smaller set with that shingle may be in it, as a mask of
    64 bits of the bands modulo 64 shows. In each meeting the largest component number isn't joined with itself: the
    numbers should follow the sizes. The order comes from a sketch of the frequencies in these rows, of a fixed size;
    it decides the work, as masks and numbers do, not the result.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text"):
                np.add.at(total, (shingle_set(text.as_py(), k) % np.uint64(SKETCH)).astype(np.int64), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    sketch = np.zeros(SKETCH, dtype=np.int64)
    for r in in_arrow(rows.select("text"), count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toLocalIterator():
        sketch[r["at"]] = r["n"]
    shared = rows.sparkSession.sparkContext.broadcast(sketch)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = shared.value
        for batch in batches:
            out: list[list[np.ndarray]] = [[] for _ in range(10)]
            for node, component, text in zip(*[batch.column(c).to_pylist() for c in ("node", "component", "text")], strict=True):
                u = shingle_set(text, k)
                n = len(u)
                u = u[np.lexsort((u, frequency[(u % np.uint64(SKETCH)).astype(np.int64)]))][: n - -(-percent * n // 100) + 1]
                token, at = u.view(np.int64), np.arange(len(u))
                before = np.concatenate([token[:1], token[:-1]])
                small = (100 + percent) * (n - at) >= 2 * percent * n
                most = np.minimum(n, (100 + percent) * (n - at) // percent - n)
                values = (token, before, np.full(len(u), node), np.full(len(u), component), np.full(len(u), n), at, small, np.full(len(u), _band(n)), _band(most), np.full(len(u), _band(-(-percent * n // 100))))
                for column, v in zip(out, values, strict=True):
                    column.append(v)
            flat = [np.concatenate(c) if c else np.zeros(0, bool if i == 6 else np.int64) for i, c in enumerate(out)]
            columns = [pa.array(flat[0]), pa.array(flat[1], mask=flat[5] == 0), *(pa.array(c) for c in flat[2:])]
            yield pa.RecordBatch.from_arrays(columns, names=["token", "before", "node", "component", "n", "at", "small", "band", "upto", "least"])

    schema = "token long, before long, node long, component long, n long, at long, small boolean, band long, upto long, least long"
    tokens = materialize(in_arrow(rows.select("node", "component", "text"), prefixes, schema), "mh-prefix")
    apart = F.min("component") != F.max("component")
    taken = F.expr("bit_or(if(small, shiftleft(1L, cast(band % 64 as int)), 0L))")
    met = tokens.groupBy("token").agg(apart.alias("apart"), taken.alias("taken")).where("apart and taken <> 0").select("token", "taken")
    shared_ones = tokens.join(met, "token")
    x = shared_ones.where("small")
    y = shared_ones.where("upto >= least").withColumn("band", F.explode(F.expr("filter(sequence(least, upto), b -> getbit(taken, cast(b % 64 as int)) = 1)"))).withColumn("small", F.lit(False))
    banded = materialize(x.unionByName(y).drop("upto", "least", "taken"), "mh-bands")
    discard(tokens)
    sides = F.bool_or("small") & F.bool_or(~F.col("small"))
    groups = banded.groupBy("token", "band").agg((apart & sides).alias("apart"), F.max("component").alias("main")).where("apart").select("token", "band", "main")
    # Few groups hold anything to compare; the joins below read those only.
    met_in = materialize(banded.join(groups, ["token", "band"]).withColumn("foreign", F.col("component") != F.col("main")), "mh-meet")
    discard(banded)
    named = lambda side: met_in.where("small" if side == "x" else "not small").select("token", "band", *[F.col(c).alias(f"{c}_{side}") for c in ("before", "node", "component", "n", "at", "foreign")])
    ordered = F.expr("(n_x < n_y or (n_x = n_y and node_x < node_y)) and component_x <> component_y")
    reach = F.expr(f"{100 + percent} * least(n_x - at_x, n_y - at_y) >= {percent} * (n_x + n_y) and 100 * n_x >= {percent} * n_y")
    # Where the shingles before agree too, the pair was met there already: only the start of a common run makes a row.
    fresh = F.expr("coalesce(before_x <> before_y, true)")
    found = None
    for left, right in ((named("x").where("foreign_x"), named("y")), (named("x").where("not foreign_x"), named("y").where("foreign_y"))):
        on = (left["token"] == right["token"]) & (left["band"] == right["band"]) & ordered & fresh & reach
        part = left.join(right, on).select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b"))
        found = part if found is None else found.union(part)
    return found.distinct()


def _band(n: np.ndarray | int) -> np.ndarray:
    """Band of a set's size: one size each up to about BANDS, then BANDS to a doubling. -1 for none."""
    return np.where(n > 0, np.floor(np.log2(np.maximum(n, 1)) * BANDS), -1).astype(np.int64)


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Links documents whose sets of k-word shingles have a Jaccard similarity of at least percent / 100.

    Returns doc_id, n_shingles, component_id (the smallest doc_id reachable over links), kept (doc_id is the
    component's), text_hash (xxhash64 of the text) and group_node (a number for the component, which null ids have
    too). Words are runs of anything but ASCII white space, with A-Z lower-cased; a text of fewer than k words is one
    shingle; texts without words (or null) have the empty set and link with nothing. Every row is a document of its
    own, also where doc_id is null or repeated: rows with equal sets are linked, rows that only share an id aren't.
    A component without any doc_id has a null component_id. An empty table gives no rows; other columns are ignored.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    sketches = in_arrow(keyed, _sketcher(k), "doc_id long, text_hash long, n_shingles long, h1 long, h2 long, halves array<long>")
    sketches = materialize(sketches.withColumn("row", F.monotonically_increasing_id()), "mh-sketch")
    sets = ["h1", "h2", "n_shingles"]
    # One node for each distinct set: its first row, which also gives its text.
    first = F.min(F.struct("row", "doc_id", "text_hash"))
    classes = sketches.where("n_shingles > 0").groupBy(*sets).agg(first.alias("f"), F.min("doc_id").alias("low"), F.min("halves").alias("halves"))
    classes = materialize(classes.select(*sets, F.col("f.row").alias("node"), "f.doc_id", "f.text_hash", "low", "halves"), "mh-class")

    # A set of u shingles can only miss one of the union's if u is at least 100 / (100 - percent).
    least = -(-percent // (100 - percent)) if percent < 100 else 1 << 60
    pairs = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(HALVES - 1)), lambda i: F.transform(F.sequence(F.lit(HALVES), F.lit(2 * HALVES - 1)), lambda j: F.xxhash64(F.get("halves", i), F.get("halves", j)))))
    keys = classes.where(F.col("n_shingles") >= least).select("node", F.explode(pairs).alias("key"))
    full = keys.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    # The nodes that meet the most others over all tables are the middles of their groups: they make the best centres.
    meets = F.sum("c").over(Window.partitionBy("node"))
    buckets = materialize(keys.join(full, "key").select("key", "node", meets.alias("meets")), "mh-bucket")
    texts = _texts(docs, classes.select("node", "doc_id", "text_hash").join(buckets.select("node").distinct(), "node", "left_semi"))

    def verified(candidates: DataFrame) -> DataFrame:
        a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        pairs = candidates.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b")
        return materialize(in_arrow(pairs, _verifier(k, percent), "a long, b long, linked boolean, alike double"), "mh-checked")

    checked: list[DataFrame] = []
    state = {"labels": components(docs.sparkSession.createDataFrame([], "a long, b long")), "open": buckets.select("*", F.col("node").alias("component"))}

    def compared(candidates: DataFrame, last: bool = False) -> bool:
        """Verifies pairs that haven't been, and redraws components and open buckets; whether a good part was linked."""
        if checked:
            candidates = candidates.join(_united(checked).select("a", "b"), ["a", "b"], "left_anti")
        checked.append(verified(candidates))
        met = checked[-1].agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("linked").cast("long")), F.lit(0)).alias("linked")).first()
        if not met["linked"]:
            return False
        discard(state["labels"])
        state["labels"] = components(_united(checked).where("linked").select("a", "b"))
        if last:
            return False
        at = buckets.join(state["labels"], "node", "left").select("key", "node", "meets", F.coalesce("component", "node").alias("component"))
        mixed = at.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
        still = materialize(at.join(mixed, "key"), "mh-open")
        discard(state["open"])
        state["open"] = still
        return met["linked"] >= SETTLED * met["n"]

    pair = lambda c: (F.least("node", c).alias("a"), F.greatest("node", c).alias("b"))
    if not buckets.isEmpty():
        centre = buckets.groupBy("key").agg(F.max(F.struct("meets", "node"))["node"].alias("c"))
        compared(buckets.join(centre, "key").where("node <> c").select(*pair("c")).distinct())
        more = True
        while more and not state["open"].isEmpty():
            # The largest component of each open bucket, by a few of its members, against all that meets it there.
            at = state["open"]
            nodes = at.select("node", "component").distinct()
            ranked = nodes.withColumn("i", F.row_number().over(Window.partitionBy("component").orderBy(F.xxhash64("node"))))
            refs = materialize(ranked.where(F.col("i") <= REFERENCES).select(F.col("component").alias("main"), F.col("node").alias("c")), "mh-refs")
            size = nodes.groupBy("component").agg(F.count("*").alias("members"))
            main = at.join(size, "component").groupBy("key").agg(F.max(F.struct("members", "component"))["component"].alias("main"))
            towards = materialize(at.join(main, "key").select("node", "component", "main").distinct(), "mh-main")
            seen = towards.join(refs, "main").where("node <> c").select("node", "component", "main", "c")
            more = compared(seen.select(*pair("c")).distinct())
            # Of its members the one most like these few is its middle, and is compared in turn.
            alike = seen.where("component = main").select("node", "main", *pair("c")).join(_united(checked).select("a", "b", "alike"), ["a", "b"])
            middle = alike.groupBy("main", "node").agg(F.sum("alike").alias("score")).groupBy("main").agg(F.max(F.struct("score", "node"))["node"].alias("c"))
            left = towards.where("component <> main").select("node", "main").join(state["open"].select("node").distinct(), "node", "left_semi")
            more = compared(left.join(middle, "main").select(*pair("c")).distinct()) or more
            discard(refs, towards)
        at = state["open"]
        if not at.isEmpty():
            left = at.select("node", "component").distinct()
            # Components numbered in the order of their sizes: one number names a component and ranks it.
            ranked = left.groupBy("component").agg(F.count("*").alias("members")).orderBy("members", "component")
            ranks = materialize(ranked.select("component", F.monotonically_increasing_id().alias("rank")), "mh-ranks")
            numbered = left.join(ranks, "component").select("node", F.col("rank").alias("component"))
            compared(_prefix_pairs(numbered.join(texts, "node"), k, percent), last=True)
            discard(ranks)
    labels = state["labels"]
    lows = classes.select(*sets, "node", "low").join(labels, "node", "left").select(*sets, "low", F.coalesce("component", "node").alias("group_node"))
    component = lows.groupBy("group_node").agg(F.min("low").alias("component_id"))
    lows = materialize(lows.drop("low").join(component, "group_node"), "mh-group")
    discard(buckets, texts, state["open"], labels, classes, *checked)
    out = sketches.select("doc_id", "text_hash", *sets).join(lows, sets, "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"), "text_hash", "group_node")


def _united(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.union(t)
    return out


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and text of wanted (node, doc_id, text_hash)."""
    keyed = docs.select(F.coalesce("doc_id", F.lit(0)).alias("d"), F.col("doc_id").isNull().alias("none"), F.xxhash64("text").alias("text_hash"), "text")
    key = ["d", "none", "text_hash"]
    wanted = wanted.select("node", F.coalesce("doc_id", F.lit(0)).alias("d"), F.col("doc_id").isNull().alias("none"), "text_hash")
    found = keyed.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted, key)
    return materialize(found.groupBy("node").agg(F.min("text").alias("text")), "mh-text")
