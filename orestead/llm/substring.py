"""Substring deduplication on a compacted de Bruijn graph of word windows.

Edges are windows of `window` words; two windows follow one another if they overlap in all but one word. The graph is
never held window by window: consecutive windows of a text with the same minimiser are one super-edge, keyed by the
minimiser and the hash of its words. Equal windows have equal minimisers, so all there is to compare meets there:

1. super-edges are counted by minimiser; those whose minimiser occurs once hold no repeated window;
2. super-edges that occur again as a whole are repeated edges; where a minimiser has several different super-edges,
   one of each is taken apart into windows, from the source text, and these are counted;
3. repeated edges compact: joins on an edge's number of distinct predecessors and successors find the branching
   places, and each text's run of edges between them is one nonbranching path;
4. a path's source coordinates are verified: all places where it is found must agree in a second, independent hash of
   the words there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import _WORDS, _WORDS2, BROADCAST_ROWS, Words, grams, in_arrow, int_lists, materialize, mix, rows_of_ids, text_blocks, unused

#: Words of a minimiser; a window of w words has w - SEED + 1 of them.
SEED = 8
NO_ID = -(1 << 63)


def _sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values, by doubling."""
    out, have = a, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


class _Sequence:
    """A block's words with both prefix hashes."""

    def __init__(self, words: Words):
        self.words, self.p1, self.p2 = words, _WORDS.prefix(words.hash), _WORDS2.prefix(words.hash)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = (end - start).astype(np.uint64)
        return mix(_WORDS.ranges(self.p1, start, end) + n), mix(_WORDS2.ranges(self.p2, start, end) ^ n)


def _super_edges(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, windows, minimiser's hash) of each run of windows with the same minimiser."""
    empty = np.zeros(0, dtype=np.int64)
    n = len(words.hash)
    if n < window:
        return empty, empty, empty, np.zeros(0, np.uint64)
    seeds = grams(words.hash, SEED)
    low = np.uint64((1 << 24) - 1)
    packed = (seeds & ~low) | (low - (np.arange(len(seeds), dtype=np.uint64) & low))
    least = _sliding_min(packed, window - SEED + 1)
    at = np.arange(len(least))
    anchor = (at & ~int(low)) | (int(low) - (least & low).astype(np.int64))
    anchor = np.where(anchor < at, anchor + (1 << 24), anchor)
    doc = np.searchsorted(words.bound, at, side="right") - 1
    inside = at + window <= words.bound[doc + 1]
    at, anchor, doc = at[inside], anchor[inside], doc[inside]
    if not len(at):
        return empty, empty, empty, np.zeros(0, np.uint64)
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(fresh)
    return doc[first], at[first], np.diff(np.append(first, len(at))), seeds[anchor[first]]


def _scanner(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column("text")):
                n, words = hi - lo, Words(data, offsets)
                seq = _Sequence(words)
                t1, t2 = seq.hashes(words.bound[:-1], words.bound[1:])
                doc, first, windows, seed = _super_edges(words, window)
                c1, c2 = seq.hashes(first, first + windows + window - 1)
                bounds = np.searchsorted(doc, np.arange(n + 1))
                raw = data.tobytes()
                sha = [hashlib.sha256(b" ".join(raw[offsets[i] : offsets[i + 1]].split())).hexdigest() for i in range(n)]
                lists = [(first - words.bound[doc]).astype(np.int32), windows.astype(np.int32), seed.view(np.int64), c1.view(np.int64), c2.view(np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, n), pa.array(np.diff(words.bound)), pa.array(t1.view(np.int64)), pa.array(t2.view(np.int64)), pa.array(sha), *(int_lists(v, bounds) for v in lists)],
                    names=["doc_id", "n_words", "t1", "t2", "sha", "start", "windows", "seed", "c1", "c2"],
                )

    return run


_SCAN = "doc_id long, n_words long, t1 long, t2 long, sha string, start array<int>, windows array<int>, seed array<long>, c1 array<long>, c2 array<long>"


def _expander(window: int):
    """Windows of the listed super-edges, hashed from the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, edges = batch.column("text"), batch.column("edges")
            for lo, hi, data, offsets in text_blocks(texts):
                words = Words(data, offsets)
                seq = _Sequence(words)
                t1, _ = seq.hashes(words.bound[:-1], words.bound[1:])
                out: list[list[np.ndarray]] = [[] for _ in range(6)]
                for i in range(hi - lo):
                    d, t = batch.column("d")[lo + i].as_py(), batch.column("t1")[lo + i].as_py()
                    if int(t1[i].view(np.int64)) != t:  # another text with the same id
                        continue
                    listed = edges[lo + i].as_py()
                    s = np.array([e["start"] for e in listed], dtype=np.int64)
                    w = np.array([e["windows"] for e in listed], dtype=np.int64)
                    lone = np.repeat(np.array([e["c"] == 1 for e in listed]), w)
                    at = np.repeat(s - (np.cumsum(w) - w), w) + np.arange(w.sum())
                    w1, w2 = seq.hashes(at + words.bound[i], at + words.bound[i] + window)
                    values = (np.full(len(at), d), np.full(len(at), t), at.astype(np.int32), w1.view(np.int64), w2.view(np.int64), lone)
                    for column, v in zip(out, values, strict=True):
                        column.append(v)
                kinds = (np.int64, np.int64, np.int32, np.int64, np.int64, bool)
                columns = [pa.array(np.concatenate(c) if c else np.zeros(0, k)) for c, k in zip(out, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["d", "t1", "start", "w1", "w2", "lone"])

    return run


@dataclass
class Repeats:
    """scan: a row per document. whole: word sequences of several documents. spans: d, t1 and word ranges of the others."""

    scan: DataFrame
    whole: DataFrame
    spans: DataFrame


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("d", F.coalesce(F.col("doc_id"), F.lit(NO_ID)))


def find_repeats(docs: DataFrame, window: int) -> Repeats:
    """All places of windows of `window` words that start more than once in docs (doc_id, text).

    spans has a row (d, t1, start, end, path, places) for each nonbranching path of repeated windows in a document whose
    words aren't those of another document: words start to end - 1 are covered. Documents with the same words are one
    occurrence there, with all of their words repeated; whole has those word sequences (t1, t2, n_words).
    """
    scan = materialize(_keyed(in_arrow(docs.select("doc_id", "text"), _scanner(window), _SCAN)), "sub-scan")
    same = ["t1", "t2", "n_words"]
    whole = materialize(scan.groupBy(*same).agg(F.count("*").alias("copies"), F.min("d").alias("d")).where("copies > 1"), "sub-whole")
    extra = scan.select("d", *same).join(whole.select(*same, F.col("d").alias("kept_d")), same).where("d <> kept_d").select("d", "t1").distinct()
    few = extra.count() <= 200_000
    one_each = scan.select("d", "t1", "start", "windows", "seed", "c1", "c2").join(F.broadcast(extra) if few else extra, ["d", "t1"], "left_anti")
    edges = one_each.select("d", "t1", F.explode(F.arrays_zip("start", "windows", "seed", "c1", "c2")).alias("e")).select("d", "t1", "e.*")

    # 1. minimisers that occur again
    again = edges.groupBy("seed").agg(F.count("*").alias("n"), F.min("c1").alias("x"), F.max("c1").alias("y")).where("n > 1").select("seed", (F.col("x") != F.col("y")).alias("several"))
    # Written, so that the join below deals a frequent minimiser's edges to several tasks.
    met = materialize(edges.join(materialize(again, "sub-again"), "seed"), "sub-met")
    # 2. whole super-edges that occur again, and windows of one super-edge of each kind
    kinds = met.where("several").groupBy("seed", "c1").agg(F.count("*").alias("c"), F.min(F.struct("d", "t1", "start", "windows")).alias("who"))
    kinds = materialize(kinds, "sub-kinds")
    whole_edges = met.where("not several").select("d", "t1", "start", "windows", "c1", "c2").union(
        met.where("several").join(kinds.where("c > 1").select("seed", "c1"), ["seed", "c1"], "left_semi").select("d", "t1", "start", "windows", "c1", "c2")
    )
    todo = kinds.select("who.d", "who.t1", F.struct("who.start", "who.windows", "c").alias("e")).groupBy("d", "t1").agg(F.collect_list("e").alias("edges"))
    texts = rows_of_ids(_keyed(docs.select("doc_id", "text")), todo.select("d").distinct(), "d").select("d", "text")
    pieces = in_arrow(todo.join(texts, "d").select("d", "t1", "edges", "text"), _expander(window), "d long, t1 long, start int, w1 long, w2 long, lone boolean")
    pieces = materialize(pieces, "sub-windows")
    seen_twice = pieces.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2")
    lone = pieces.where("lone").join(seen_twice, ["w1", "w2"], "left_semi")
    repeated = whole_edges.withColumn("single", F.lit(False)).union(
        lone.select("d", "t1", "start", F.lit(1).alias("windows"), F.col("w1").alias("c1"), F.col("w2").alias("c2"), F.lit(True))
    )

    # 3. compaction: an edge may follow the one before it on the same path if neither branches there
    order = Window.partitionBy("d", "t1").orderBy("start")
    follows = F.lag(F.struct((F.col("start") + F.col("windows")).alias("stop"), "c1")).over(order)
    nearby = F.lead(F.struct("start", "c1")).over(order)
    repeated = repeated.withColumn("p", follows).withColumn("q", nearby)
    repeated = repeated.withColumn("before", F.when(F.col("p.stop") == F.col("start"), F.col("p.c1"))).withColumn(
        "after", F.when(F.col("q.start") == F.col("start") + F.col("windows"), F.col("q.c1"))
    )
    repeated = materialize(repeated.select("d", "t1", "start", "windows", "c1", "c2", "single", "before", "after"), "sub-edges")
    lonely = lambda c: (F.min(c) == F.max(c)) & (F.count(c) == F.count("*"))
    degree = repeated.groupBy("c1").agg(lonely("before").alias("one_before"), lonely("after").alias("one_after"))
    flagged = repeated.join(degree, "c1")
    joined = F.lag("one_after").over(order) & F.col("one_before") & F.col("before").isNotNull()
    flagged = flagged.withColumn("cut", F.when(joined, 0).otherwise(1))
    flagged = flagged.withColumn("path_no", F.sum("cut").over(order))
    listed = F.array_sort(F.collect_list(F.struct("start", "windows", "c1", "c2")))
    paths = flagged.groupBy("d", "t1", "path_no").agg(listed.alias("edges"), F.every("single").alias("single"))
    last = F.element_at("edges", -1)
    paths = materialize(
        paths.select("d", "t1", F.get("edges", F.lit(0))["start"].alias("start"), (last["start"] + last["windows"] + F.lit(window - 1)).alias("end"), F.get("edges", F.lit(0))["c1"].alias("path"), F.xxhash64(F.col("edges.c2")).alias("check"), "single"),
        "sub-paths",
    )
    # 4. verification at the source coordinates; single windows were compared on both hashes
    agreed = paths.where("not single").groupBy("path", "check").agg(F.count("*").alias("places")).where("places > 1")
    spans = paths.where("single").withColumn("places", F.lit(None).cast("long")).unionByName(paths.where("not single").join(agreed, ["path", "check"]), allowMissingColumns=True)
    spans = spans.join(whole.select("d", "t1"), ["d", "t1"], "left_anti")
    return Repeats(scan, whole, spans.select("d", "t1", "start", "end", "path", "places"))


def _covered(n: int, spans: list[dict]) -> np.ndarray:
    delta = np.zeros(n + 1, dtype=np.int64)
    for s in spans:
        delta[s["start"]] += 1
        delta[min(s["end"], n)] -= 1
    return np.cumsum(delta)[:-1] > 0


def _cutter(with_text: bool):
    """Per row (d, t1, text, spans): words removed, and the kept words' digest or the kept text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for lo, hi, data, offsets in text_blocks(batch.column("text")):
                words = Words(data, offsets)
                t1, _ = _Sequence(words).hashes(words.bound[:-1], words.bound[1:])
                raw = data.tobytes()
                for i in range(hi - lo):
                    d, t = batch.column("d")[lo + i].as_py(), batch.column("t1")[lo + i].as_py()
                    if int(t1[i].view(np.int64)) != t:
                        continue
                    a, b = int(words.bound[i]), int(words.bound[i + 1])
                    gone = _covered(b - a, batch.column("spans")[lo + i].as_py())
                    text = raw[offsets[i] : offsets[i + 1]]
                    if not with_text:
                        kept = b" ".join(compress(text.split(), ~gone))
                        out.append((d, t, int(gone.sum()), hashlib.sha256(kept).hexdigest()))
                        continue
                    # Each word goes with the white space after it.
                    starts = np.append(words.start[a:b], offsets[i + 1]) - offsets[i]
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                    parts, at = [], 0
                    for x, y in zip(edge[::2], edge[1::2], strict=True):
                        parts.append(text[at : starts[x]])
                        at = starts[y]
                    out.append((d, t, int(gone.sum()), b"".join([*parts, text[at:]]).decode()))
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["d", "t1", "n_removed", "kept"])

    return run


def _cut(docs: DataFrame, spans: DataFrame, with_text: bool) -> DataFrame:
    grouped = materialize(spans.groupBy("d", "t1").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "sub-spans")
    texts = rows_of_ids(_keyed(docs.select("doc_id", "text")), grouped.select("d").distinct(), "d").select("d", "text").distinct()
    return in_arrow(grouped.join(texts, "d").select("d", "t1", "text", "spans"), _cutter(with_text), "d long, t1 long, n_removed long, kept string")


def _with_t1(name: str):
    """Rows with the hash of their text's words, as the scan has it, in a further column: tells rows that share an id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.int64)]
            for _, _, data, offsets in text_blocks(batch.column("text")):
                words = Words(data, offsets)
                t1, _ = _Sequence(words).hashes(words.bound[:-1], words.bound[1:])
                found.append(t1.view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(found))], names=[*batch.schema.names, name])

    return run


_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def remove_repeats_digest(docs: DataFrame, window: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of what is kept (words joined by a space), per row of docs.

    A word goes if a window of `window` consecutive words that covers it starts at another place too, in any document.
    Null and empty texts have no words. Repeated rows are other places for one another. doc_id may be null or repeated.
    An empty table gives no rows; columns other than doc_id and text are ignored.
    """
    found = find_repeats(docs, window)
    cut = _cut(docs, found.spans, with_text=False)
    rows = found.scan.select("doc_id", "d", "n_words", "t1", "t2", "sha")
    rows = rows.join(found.whole.select("t1", "t2", "n_words", "copies"), ["t1", "t2", "n_words"], "left").join(cut, ["d", "t1"], "left")
    whole = F.col("copies").isNotNull() & (F.col("n_words") >= window)
    return rows.select(
        "doc_id", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(_EMPTY_SHA)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """docs with the repeated words taken out of the texts; other rows and columns stay as they are.

    White space around kept words stays too. A text that consisted of repeats is empty afterwards; null stays null.
    Rows whose doc_id is null or repeated are each cut by their own text.
    """
    found = find_repeats(docs, window)
    cut = _cut(docs, found.spans, with_text=True)
    rows = found.scan.select("d", "t1", "t2", "n_words")
    gone = rows.join(found.whole.select("t1", "t2", "n_words"), ["t1", "t2", "n_words"], "left_semi").where(F.col("n_words") >= window).select("d", "t1", F.lit("").alias("kept"))
    changed = cut.select("d", "t1", "kept").union(gone).dropDuplicates(["d", "t1"])
    d, t1, kept = unused(docs, "_d", "_t1", "_kept")
    changed = materialize(changed.select(F.col("d").alias(d), F.col("t1").alias(t1), F.col("kept").alias(kept)), "sub-changed")
    ids = changed.select(d).distinct()
    small = ids.count() <= BROADCAST_ROWS
    keyed = docs.withColumn(d, F.coalesce("doc_id", F.lit(NO_ID)))
    out = keyed.join(F.broadcast(ids) if small else ids, d, "left_anti").select(*docs.columns)
    near = keyed.join(F.broadcast(ids) if small else ids, d, "left_semi")
    hit = in_arrow(near, _with_t1(t1), StructType([*near.schema.fields, StructField(t1, LongType())])).join(changed, [d, t1], "left")
    return out.unionByName(hit.withColumn("text", F.when(F.col("text").isNotNull(), F.coalesce(kept, "text"))).select(*docs.columns))
