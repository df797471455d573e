"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph (a line) hashes to a wide vector; a document's fingerprint is the sum of its paragraphs' vectors, modulo
2**16 in the IDENTITY lanes and modulo 2**32 in the SKETCH lanes. So the order of paragraphs doesn't matter, and one can be put in or taken out by adding or
subtracting its vector (insert, delete). The first IDENTITY lanes are the paragraph's BLAKE2b digest: they tell whether
two multisets are equal. The other SKETCH lanes sum signs of the paragraph's word shingles; differences of those sums
are small numbers, centred modulo 2**32, and give the likeness of two documents.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, Words, grams, in_arrow, mix, ship, shuffle_partitions

IDENTITY, SKETCH = 32, 256
SHINGLE = 3
#: Bytes of text that one range of neighbouring documents should have.
GROUP_BYTES = 64 << 20


def _vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """uint32 fingerprints of a block of documents, (documents, lanes); the IDENTITY lanes stay below 2**16."""
    n = len(offsets) - 1
    out = np.zeros((n, IDENTITY + SKETCH), dtype=np.uint32)
    raw = data.tobytes()
    digests, owner = [], []
    for i in range(n):
        lines = raw[offsets[i] : offsets[i + 1]].split(b"\n")
        digests += [hashlib.blake2b(x).digest() for x in lines]
        owner.append(len(lines))
    wide = np.frombuffer(b"".join(digests), dtype="<u2").reshape(-1, IDENTITY)
    first = np.concatenate([[0], np.cumsum(owner)[:-1]]).astype(np.int64)
    out[:, :IDENTITY] = np.add.reduceat(wide, first, axis=0, dtype=np.uint16)
    # Shingles stay inside a paragraph; a paragraph of fewer words is one shingle.
    breaks = np.union1d(offsets, np.flatnonzero(data == 10))
    words = Words(data, offsets)
    if len(words.hash):
        line = np.searchsorted(breaks, words.start, side="right")
        doc = np.searchsorted(offsets, words.start, side="right") - 1
        features, owners = [], []
        for k in range(1, SHINGLE + 1):
            h = grams(words.hash, k)
            m = len(h)
            if not m:
                continue
            same = line[:m] == line[k - 1 :]
            if k < SHINGLE:
                starts = np.ones(m, dtype=bool)
                starts[1:] = line[1:m] != line[: m - 1]
                ends = np.ones(m, dtype=bool)
                ends[: len(line) - k] = line[k:] != line[k - 1 : -1]
                same &= starts & ends
            features.append(h[same])
            owners.append(doc[:m][same])
        h, doc = mix(np.concatenate(features)), np.concatenate(owners)
        lane = (h % np.uint64(SKETCH)).astype(np.int64)
        sign = np.where((h >> np.uint64(63)).astype(bool), 1.0, -1.0)
        sums = np.bincount(doc * SKETCH + lane, weights=sign, minlength=n * SKETCH).astype(np.int64)
        out[:, IDENTITY:] = sums.reshape(n, SKETCH).astype(np.uint32)
    return out


def _long(text: bytes) -> np.ndarray:
    """A long text's vector: the sum of those of its runs of lines, of bounded size unless a line is longer."""
    total, lo = np.zeros(IDENTITY + SKETCH, np.uint32), 0
    while lo <= len(text):
        hi = len(text) if len(text) - lo <= BLOCK_BYTES else text.rfind(b"\n", lo, lo + BLOCK_BYTES)
        if hi < 0:
            hi = text.find(b"\n", lo + BLOCK_BYTES)
        hi = len(text) if hi < 0 else hi
        total += _vectors(np.frombuffer(text[lo:hi], np.uint8), np.array([0, hi - lo]))[0]
        lo = hi + 1
    total[:IDENTITY] &= np.uint32(0xFFFF)
    return total


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """Vectors of many texts, a bounded number of bytes at a time."""
    parts, lo = [], 0
    while lo < len(texts):
        if len(texts[lo]) > BLOCK_BYTES:
            parts.append(_long(texts[lo])[None])
            lo += 1
            continue
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= BLOCK_BYTES):
            size += len(texts[hi])
            hi += 1
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts[lo:hi]])]).astype(np.int64)
        parts.append(_vectors(np.frombuffer(b"".join(texts[lo:hi]), dtype=np.uint8), offsets))
        lo = hi
    return np.concatenate(parts) if parts else np.zeros((0, IDENTITY + SKETCH), np.uint32)


def fingerprint(text: str | None) -> str:
    return encode(fingerprints([(text or "").encode()])[0])


def encode(vector: np.ndarray) -> str:
    return base64.b64encode(vector[:IDENTITY].astype("<u2").tobytes() + vector[IDENTITY:].astype("<u4").tobytes()).decode()


def decode(value: str) -> np.ndarray:
    raw = base64.b64decode(value)
    return np.concatenate([np.frombuffer(raw, "<u2", IDENTITY).astype(np.uint32), np.frombuffer(raw, "<u4", SKETCH, 2 * IDENTITY)])


def insert(value: str, paragraph: str) -> str:
    """The fingerprint with one more paragraph. A text of no paragraphs still has the empty one."""
    return encode(decode(value) + decode(fingerprint(paragraph)))


def delete(value: str, paragraph: str) -> str:
    return encode(decode(value) - decode(fingerprint(paragraph)))


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 to 1 for each pair of vectors: the part of both multisets of shingles that is common; 1 for equal ones."""
    x, y = (v[..., IDENTITY:].view(np.int32).astype(np.float64) for v in (a, b))
    apart = (a[..., IDENTITY:] - b[..., IDENTITY:]).view(np.int32).astype(np.float64)
    size = (x * x).sum(-1) + (y * y).sum(-1)
    part = 1 - (apart * apart).sum(-1) / np.where(size > 0, size, 1)
    part = np.where(size > 0, np.clip(part, 0, 1), 0.0)
    return np.where((a == b).all(-1), 1.0, part)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order (g, document); the last of each group is its successor only. Holds one batch and one row at a time."""
    held: tuple | None = None  # group, doc_id, own, text, vector
    for batch in batches:
        group, ids, own = (batch.column(c).to_pylist() for c in ("g", "doc_id", "own"))
        texts = [t or "" for t in batch.column("text").to_pylist()]
        vectors = fingerprints([t.encode() for t in texts])
        before = [held] if held else []
        rows = before + list(zip(group, ids, own, texts, vectors, strict=True))
        pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a[2] and a[0] == b[0]]  # noqa: B905
        held = rows[-1] if rows else None
        if pairs:
            yield _compared(pairs)


def _compared(pairs: list[tuple]) -> pa.RecordBatch:
    edited, counts = [], []
    for a, b in pairs:
        n = len(a[3])
        cut = n // 4
        counts.append(n)
        edited.append((a[3][: n - cut] + b[3][:cut]).encode())
    own, following, changed = np.stack([a[4] for a, _ in pairs]), np.stack([b[4] for _, b in pairs]), fingerprints(edited)
    columns = {
        "doc_id": pa.array([a[1] for a, _ in pairs], pa.int64()), "n_chars": pa.array(counts, pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
        "fingerprint": pa.array([encode(v) for v in own]), "edited_fingerprint": pa.array([encode(v) for v in changed]),
        "near_edited": pa.array(likeness(own, changed)), "near_next": pa.array(likeness(own, following)),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def fingerprint_neighbours(docs: DataFrame, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many of the next document's (or
    all it has), in ascending order of doc_id; after the last comes the first. Returns doc_id, n_chars (code points),
    edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    Documents go to ranges of neighbours of about group_bytes, in the order of doc_id and then a hash of the text, so rows of a null
    or repeated id are dealt to several; a range's rows stream through its task one batch at a time. Each range also
    gets the document that begins the next one. The driver holds the first key of each range, as Spark does for any sort.
    Null text reads as empty; null doc_ids come first; only rows equal in doc_id and text, whose order doesn't matter,
    stay together. A lone document is its own next. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select("doc_id", "text").withColumn("h", F.xxhash64("text"))
    order = [F.col("doc_id").isNotNull().cast("int").alias("some"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("h")]
    narrow = rows.select(*order, F.octet_length("text").alias("bytes"))
    total = narrow.agg(F.sum("bytes").alias("b")).first()["b"] or 0
    groups = max(shuffle_partitions(spark), math.ceil(total / group_bytes))
    first = narrow.repartitionByRange(groups, "some", "id", "h").groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("some", "id", "h")).alias("m"))
    marks = sorted(tuple(r["m"]) for r in first.select("m").collect())
    if not marks:
        return in_arrow(rows.select(F.lit(0).alias("g"), F.lit(1).alias("own"), "doc_id", "text"), _stream, _RESULT)
    shared = spark.sparkContext.broadcast(marks)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in ("some", "id", "h")], strict=True)
            place = [bisect.bisect_right(at, k) - 1 for k in keys]
            # The document that begins a range also ends the one before; the very first ends the last.
            twice = [i for i, g in enumerate(place) if all(batch.column(c)[i].as_py() == v for c, v in zip(("some", "id", "h"), at[g], strict=True))]
            take = pa.array([*range(len(place)), *twice], pa.int64())
            g = [*place, *[(place[i] - 1) % len(at) for i in twice]]
            own = [1] * len(place) + [0] * len(twice)
            columns = {c: batch.column(c).take(take) for c in ("some", "id", "h", "doc_id", "text")}
            columns |= {"g": pa.array(g, pa.int32()), "own": pa.array(own, pa.int32())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    dealt = in_arrow(rows.select(*order, "doc_id", "text"), search, "some int, id long, h long, doc_id long, text string, g int, own int")
    dealt = dealt.repartition(groups, "g").sortWithinPartitions("g", F.desc("own"), "some", "id", "h")
    return in_arrow(dealt.select("g", "own", "doc_id", "text"), _stream, _RESULT)


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
