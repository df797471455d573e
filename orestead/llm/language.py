"""Language identification by rank-order profiles.

A profile is a language's most frequent letter n-grams in order. A document's own most frequent n-grams are compared
with each profile by out-of-place distance: the sum over its n-grams of how far their ranks are apart, with a fixed
penalty for those that a profile lacks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import in_arrow

#: n-grams of a profile and of a document; also the penalty.
RANKS = 400
ORDERS = (1, 2, 3)
#: About how many labelled documents profiles are learnt from, at most; they are chosen by hash.
MAX_FIT = 20_000
BLOCK_CHARS = 1 << 19
UNKNOWN = "und"

_codes: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point its lower case if it is a letter, else 0; letters beyond 0xFFFF are folded to 16 bits."""
    if not _codes:
        table = np.zeros(0x110000, dtype=np.uint16)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = (ord(low) if len(low) == 1 else c) & 0xFFFF or 1
        _codes.append(table)
    return _codes[0]


def _ngrams(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first, end, document, n-gram, count, has letters) of runs of texts; words are set off by one space."""
    table, lo = _letters(), 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= BLOCK_CHARS) and hi - lo < 1024:
            size += len(texts[hi])
            hi += 1
        cps = np.frombuffer(("\n".join(texts[lo:hi]) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        code = table[cps].astype(np.int64)
        ends = np.cumsum([len(t) + 1 for t in texts[lo:hi]])
        doc = np.repeat(np.arange(hi - lo), np.diff(np.concatenate([[0], ends])))
        lettered = np.bincount(doc[code > 0], minlength=hi - lo) > 0
        keep = np.ones(len(code), dtype=bool)
        keep[1:] = (code[1:] > 0) | (code[:-1] > 0) | (doc[1:] != doc[:-1])
        code, doc = code[keep], doc[keep]
        # 10 bits of document, 2 of order, 48 of n-gram.
        keys = []
        for k in ORDERS:
            gram = np.zeros(max(0, len(code) - k + 1), dtype=np.int64)
            for j in range(k):
                gram = (gram << 16) | code[j : len(code) - k + 1 + j]
            inside = doc[: len(gram)] == doc[k - 1 :]
            if k == 1:
                inside = inside & (code > 0)
            elif k == 3:  # a space in the middle joins two words
                inside = inside & (code[1:-1] > 0)
            keys.append((doc[: len(gram)][inside] << 50) | (k << 48) | gram[inside])
        key = np.sort(np.concatenate(keys))
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        key, count = key[first], np.diff(np.append(first, len(key)))
        yield lo, hi, key >> 50, key & ((1 << 50) - 1), count, lettered
        lo = hi


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        names = sorted(set(langs))
        code = np.array([names.index(x) for x in langs], dtype=np.int64)
        total: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for lo, _, doc, gram, count, _ in _ngrams(batch.column("text").to_pylist()):
            for c in range(len(names)):
                mine = code[lo + doc] == c
                g, n = gram[mine], count[mine]
                if c in total:
                    g, n = np.concatenate([total[c][0], g]), np.concatenate([total[c][1], n])
                g, back = np.unique(g, return_inverse=True)
                total[c] = (g, np.bincount(back, weights=n, minlength=len(g)).astype(np.int64))
        for c, (g, n) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([names[c]] * len(g), pa.string()), pa.array(g), pa.array(n)], names=["lang", "gram", "n"])


def fit_profiles(labelled: DataFrame, max_fit: int = MAX_FIT) -> dict[str, list[int]]:
    """The RANKS most frequent n-grams of each value of lang, ties by n-gram.

    labelled has text and lang, without nulls, and may have doc_id. Each label has an equal part of max_fit; of one with more rows
    about so many are chosen, by a hash of the row. There are as many profiles as labels, which are taken to be few.
    """
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if sum(sizes.values()) > max_fit:
        spot = F.pmod(F.xxhash64("text", *["doc_id"] * ("doc_id" in labelled.columns)), F.lit(1 << 40))
        share = F.lit(1 << 40)
        for lang, n in sizes.items():
            share = F.when(F.col("lang") == lang, F.lit(math.ceil((1 << 40) * min(1.0, max_fit / len(sizes) / n)))).otherwise(share)
        labelled = labelled.where(spot < share)
    counts = in_arrow(labelled.select("lang", "text"), _counter, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = counts.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("r") <= RANKS)
    profiles: dict[str, list[tuple[int, int]]] = {}
    for r in top.collect():
        profiles.setdefault(r["lang"], []).append((r["r"], r["gram"]))
    return {lang: [g for _, g in sorted(rows)] for lang, rows in sorted(profiles.items())}


def _predictor(profiles: dict[str, list[int]], carried: list[str], called: tuple[str, str]):
    names = list(profiles)
    grams = np.unique(np.array([g for p in profiles.values() for g in p], dtype=np.int64))
    rank = np.full((len(grams) + 1, len(names)), -1, dtype=np.int64)
    for j, p in enumerate(profiles.values()):
        rank[np.searchsorted(grams, p), j] = np.arange(len(p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            pred, score = np.full(n, UNKNOWN, dtype=object), np.zeros(n)
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for lo, hi, doc, gram, count, lettered in _ngrams(texts) if names else ():
                order = np.lexsort((gram, -count, doc))
                doc, gram = doc[order], gram[order]
                first = np.searchsorted(doc, np.arange(hi - lo))
                place = np.arange(len(doc)) - first[doc]
                doc, gram, place = (x[place < RANKS] for x in (doc, gram, place))
                at = np.searchsorted(grams, gram)
                at = np.where((at < len(grams)) & (grams[np.minimum(at, len(grams) - 1)] == gram), at, len(grams))
                theirs = rank[at]
                apart = np.where(theirs < 0, RANKS, np.abs(theirs - place[:, None]))
                used = np.bincount(doc, minlength=hi - lo)
                total = np.stack([np.bincount(doc, weights=apart[:, j], minlength=hi - lo) for j in range(len(names))], axis=1)
                best = total.argmin(axis=1)
                near = 1 - total.min(axis=1) / np.maximum(used * RANKS, 1)
                pred[lo:hi] = np.where(lettered, np.array(names, dtype=object)[best], UNKNOWN)
                score[lo:hi] = np.where(lettered, np.clip(near, 0, 1), 0)
            columns = {c: batch.column(c) for c in carried} | {called[0]: pa.array(pred.tolist(), pa.string()), called[1]: pa.array(score)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, profiles: dict[str, list[int]], carry: tuple[str, ...] = ("doc_id",), names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """lang_pred and score (1 for identical ranks, 0 for nothing in common) of every whole text, with the columns in carry.

    Only the text decides. Without a letter (or text, or any profile) the language is `und` and the score 0. Equal
    distances go to the first language by name. names are what the two results are called; columns of carry with these
    names are replaced. A text of any length is counted in pieces.
    """
    carry = tuple(c for c in carry if c not in names)
    rows = docs.select(*dict.fromkeys([*carry, "text"]))
    schema = StructType([*(rows.schema[c] for c in carry), StructField(names[0], StringType()), StructField(names[1], DoubleType())])
    return in_arrow(rows, _predictor(profiles, list(carry), names), schema)


def learn(docs: DataFrame, max_fit: int = MAX_FIT) -> dict[str, list[int]]:
    """Profiles from docs that are not held out and have a label."""
    return fit_profiles(docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))), max_fit)
