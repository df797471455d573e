"""Shared helpers: scratch tables in the cluster's shared folder, and word hashing over Arrow buffers."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

#: Bytes of text that one numpy pass works on; temporaries are about 8 times that each.
BLOCK_BYTES = 1 << 20
#: Rows of an Arrow batch at most: both the JVM and the worker hold a batch of texts, some of which are very long.
BATCH_KEY, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000
#: A side may be broadcast if it was counted and holds no more rows of a few longs than this.
BROADCAST_ROWS = 200_000

_own: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir, or one of our own where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        if spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
            folder = tempfile.TemporaryDirectory(prefix="orestead-", ignore_cleanup_errors=True)
            atexit.register(folder.cleanup)
            _own[app] = f"file://{folder.name}"
        else:
            _own[app] = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return _own[app]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts the lineage, survives a lost executor, prunes columns.

    discard() deletes it; else it goes when the driver ends.
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/orestead/{name}-{uuid.uuid4().hex}"
    _folder(spark, path, "deleteOnExit")
    df.write.mode("append").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._orestead_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes what materialize() wrote, once nothing reads it any more."""
    for df in tables:
        path = getattr(df, "_orestead_path", None)
        if path:
            _folder(df.sparkSession, path, "delete", True)


def _folder(spark: SparkSession, path: str, call: str, *args: bool) -> None:
    """A call of the file system that holds path. deleteOnExit only notes folders that exist."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if call == "deleteOnExit":
        system.mkdirs(at)
    getattr(system, call)(at, *args)


def in_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """df.mapInArrow, with this package on the workers and batches small enough for whole texts."""
    ship(df.sparkSession)
    if int(df.sparkSession.conf.get(BATCH_KEY)) > BATCH_ROWS:
        df.sparkSession.conf.set(BATCH_KEY, str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def unused(df: DataFrame, *names: str) -> list[str]:
    """names, with underscores put before until no column of df has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
        taken.add(name.lower())
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def rows_of_ids(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of docs whose key is in ids (one column, distinct).

    A counted, small id set is broadcast, so texts needn't be shuffled; a larger one is joined by shuffle.
    """
    n = ids.count()
    return docs.join(F.broadcast(ids) if n <= BROADCAST_ROWS else ids, key, "left_semi")


# --- words over Arrow buffers -------------------------------------------------------------

#: ASCII white space that ends a word: space and 0x09 to 0x0D. UTF-8 continuation bytes are never among them.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial hashes modulo 2**64 of any range, from prefix sums."""

    def __init__(self, seed: int):
        self.base = np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1) | 1) & (2**64 - 1))
        self.inverse = np.uint64(pow(int(self.base), -1, 2**64))
        self.table = mix(np.arange(256, dtype=np.uint64) + np.uint64(1000 * seed + 7))
        self._p = self._q = np.ones(1, dtype=np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self._p) < n:
            m = len(self._p)
            self._p = np.concatenate([self._p, self._p * (self._p[-1:] * self.base)])
            self._q = np.concatenate([self._q, self._q * (self._q[-1:] * self.inverse)])
            assert len(self._p) == 2 * m
        return self._p, self._q

    def prefix(self, values: np.ndarray) -> np.ndarray:
        p, _ = self.powers(len(values) + 1)
        out = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * p[: len(values)], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of values[start:end] for each pair."""
        _, q = self.powers(len(prefix))
        return (prefix[end] - prefix[start]) * q[start]


_BYTES, _WORDS, _WORDS2 = Rolling(1), Rolling(2), Rolling(3)


class Words:
    """Words of a block of documents: byte ranges, 64-bit hashes, and each document's range of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, breaks: np.ndarray | None = None):
        data = LOWER[data] if lower else data
        self.data, self.offsets = data, offsets
        ns = ~SPACE[data]
        edge = offsets if breaks is None else breaks
        edge = edge[(edge > 0) & (edge < len(data))]
        first, last = ns.copy(), ns.copy()
        first[1:] &= ~ns[:-1]
        first[edge] = ns[edge]
        last[:-1] &= ~ns[1:]
        last[edge - 1] = ns[edge - 1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        prefix = _BYTES.prefix(_BYTES.table[data])
        self.hash = mix(_BYTES.ranges(prefix, self.start, self.end) + (self.end - self.start).astype(np.uint64))
        #: Words before each document, and in all: document i has words bound[i] to bound[i + 1].
        self.bound = np.searchsorted(self.start, offsets)


def grams(hashes: np.ndarray, k: int, second: bool = False) -> np.ndarray:
    """64-bit hash of each k consecutive words (also across documents; mask those out)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    roll = _WORDS2 if second else _WORDS
    prefix, at = roll.prefix(hashes), np.arange(n)
    return mix(roll.ranges(prefix, at, at + k))


def text_blocks(column: pa.Array, target: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about target bytes; null reads as empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + target, side="right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def int_lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A list column from flat values and bounds (one more than rows)."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))
