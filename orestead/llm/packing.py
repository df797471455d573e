"""Packing token sequences by linear grouping and configurations, then best fit.

Only the histogram of piece lengths decides a packing, and it has at most `capacity` entries however many documents
there are. On it the driver works as in the scheme of linear grouping: large lengths are put into groups of equal
cardinality and rounded up to each group's largest, a linear program over configurations of those few sizes is solved
by column generation and rounded down, the actual lengths replace the rounded ones, and what is left over and the
small lengths are placed by best fit. The outcome is a list of ranges (length, ranks) -> (sequences, offset), whose
size again depends on the capacity; documents look their place up by their length and their rank in that length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_arrow, materialize, shuffle_partitions, text_blocks
from .tokens import CachedTokenizer

#: (groups, part): lengths over capacity / part are large and put into so many groups; the best of these is kept.
SCHEMES = ((10, 2), (20, 2), (40, 2), (20, 3))

_tokenizers: dict[str, CachedTokenizer] = {}


def _tokenizer(path: str) -> CachedTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = CachedTokenizer(path)
    return _tokenizers[path]


def _piece_maker(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        try:
            for batch in batches:
                for lo, hi, data, offsets in text_blocks(batch.column("text")):
                    raw = data.tobytes()
                    encoded = tokenizer.encode([raw[offsets[i] : offsets[i + 1]].decode() for i in range(hi - lo)])
                    rows, piece, start, length, crc, ids = [], [], [], [], [], []
                    for i, e in enumerate(encoded):
                        e = np.append(e, np.uint32(end_id)).astype("<u4")
                        for k, at in enumerate(range(0, len(e), capacity)):
                            part = e[at : at + capacity]
                            rows.append(lo + i)
                            piece.append(k)
                            start.append(at)
                            length.append(len(part))
                            crc.append(zlib.crc32(part.tobytes()))
                            ids.append(part.astype(np.int64) if with_ids else None)
                    columns = [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                    if with_ids:
                        columns.append(pa.array(ids, pa.list_(pa.int64())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names=names)
        finally:  # workers live on: they shouldn't keep the words of tasks that are done
            tokenizer.clear()

    return run


# --- the plan, on the histogram -----------------------------------------------------------


def _groups(large: list[tuple[int, int]], n_groups: int) -> list[list[tuple[int, int]]]:
    """(length, count) runs, longest first, cut into groups of equal cardinality."""
    total = sum(c for _, c in large)
    each = -(-total // n_groups)
    out: list[list[tuple[int, int]]] = [[]]
    room = each
    for length, count in large:
        while count:
            take = min(count, room)
            out[-1].append((length, take))
            count, room = count - take, room - take
            if not room:
                out.append([])
                room = each
    return [g for g in out if g]


def _best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """Unbounded knapsack: how many of each size to take."""
    best = np.zeros(capacity + 1)
    for u, y in zip(sizes, worth, strict=True):
        if y <= 0:
            continue
        for at in range(u, capacity + 1, u):
            stop = min(at + u, capacity + 1)
            np.maximum(best[at:stop], best[at - u : stop - u] + y, out=best[at:stop])
    take, left = np.zeros(len(sizes), dtype=np.int64), capacity
    while left > 0 and best[left] > 1e-12:
        for g, (u, y) in enumerate(zip(sizes, worth, strict=True)):
            if u <= left and y > 0 and abs(best[left - u] + y - best[left]) < 1e-9:
                take[g] += 1
                left -= u
                break
        else:
            left -= 1
    return take


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations with their numbers: the linear program's basis, rounded down."""
    n = len(sizes)
    u, d = np.array(sizes), np.array(demand, dtype=float)
    basis = np.diag((capacity // u).astype(float))
    x = d / np.diag(basis)
    for _ in range(600):
        worth = np.linalg.solve(basis.T, np.ones(n))
        column = _best_configuration(u, worth, capacity)
        if worth @ column <= 1 + 1e-7:
            break
        step = np.linalg.solve(basis, column.astype(float))
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        leave = int(np.argmin(ratio))
        if not np.isfinite(ratio[leave]):
            break
        x = x - ratio[leave] * step
        x[leave] = ratio[leave]
        basis[:, leave] = column
        x = np.maximum(x, 0)
    return [(np.rint(basis[:, j]).astype(np.int64), int(x[j] + 1e-6)) for j in range(n) if int(x[j] + 1e-6) > 0]


class _Bins:
    """Classes of equal sequences by room left, with the smallest sufficient room found by a bit mask."""

    def __init__(self, capacity: int):
        self.by_room: list[list[tuple[int, tuple]]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def put(self, room: int, number: int, content: tuple) -> None:
        if number:
            self.by_room[room].append((number, content))
            self.mask |= 1 << room

    def take(self, length: int) -> tuple[int, int, tuple] | None:
        fit = self.mask >> length
        if not fit:
            return None
        room = length + (fit & -fit).bit_length() - 1
        number, content = self.by_room[room].pop()
        if not self.by_room[room]:
            self.mask &= ~(1 << room)
        return room, number, content


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Ranges (length, first rank, first sequence, sequences, offset) and the number of sequences, by the best scheme."""
    return min((_plan(histogram, capacity, *scheme) for scheme in SCHEMES), key=lambda x: x[1])


def _plan(histogram: dict[int, int], capacity: int, n_groups: int, part: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """A range's ranks go round its sequences: rank r is in sequence first + (r - first rank) % sequences, and lies
    length x ((r - first rank) // sequences) after the offset.
    """
    bins, left = _Bins(capacity), dict(histogram)
    if capacity in left:
        bins.put(0, left.pop(capacity), ((capacity, 1),))
    large = sorted(((n, c) for n, c in left.items() if n > capacity // part), reverse=True)
    if large:
        groups = _groups(large, min(n_groups, sum(c for _, c in large)))
        runs = [[list(r) for r in g] for g in groups]
        merged: dict[int, int] = {}
        for g in groups:
            merged[g[0][0]] = merged.get(g[0][0], 0) + sum(c for _, c in g)
        # Groups with the same largest length are one size.
        sizes = sorted(merged, reverse=True)
        stock: dict[int, list[list[int]]] = {u: [] for u in sizes}
        for g in runs:
            stock[g[0][0]] += g
        for config, number in configurations(sizes, [merged[u] for u in sizes], capacity):
            slots: list[list[list[int]]] = []
            for u, copies in zip(sizes, config, strict=True):
                for _ in range(int(copies)):
                    need, runs_here = number, []
                    while need and stock[u]:
                        run = stock[u][0]
                        take = min(need, run[1])
                        runs_here.append([run[0], take])
                        run[1] -= take
                        need -= take
                        if not run[1]:
                            stock[u].pop(0)
                    if need:
                        runs_here.append([0, need])
                    slots.append(runs_here)
            done = 0
            while done < number:
                step = min(s[0][1] for s in slots)
                held: dict[int, int] = {}
                for s in slots:
                    if s[0][0]:
                        held[s[0][0]] = held.get(s[0][0], 0) + 1
                    s[0][1] -= step
                    if not s[0][1]:
                        s.pop(0)
                if held:
                    bins.put(capacity - sum(n * q for n, q in held.items()), step, tuple(sorted(held.items(), reverse=True)))
                done += step
        for n, _ in large:
            left.pop(n, None)
        for runs_left in stock.values():
            for n, c in runs_left:
                left[n] = left.get(n, 0) + c
    for n in sorted(left, reverse=True):
        count = left[n]
        while count:
            found = bins.take(n)
            room, number, content = found or (capacity, -(-count // (capacity // n)), ())
            most = room // n
            if count < most:
                bins.put(room, number - 1, content)
                bins.put(room - n * count, 1, (*content, (n, count)))
                break
            used = min(number, count // most)
            bins.put(room, number - used if found else 0, content)
            bins.put(room - n * most, used, (*content, (n, most)))
            count -= used * most
    ranges, ranks, sequence = [], {}, 0
    for classes in bins.by_room:
        for number, content in classes:
            offset = 0
            for n, q in content:
                ranges.append((n, ranks.get(n, 0), sequence, number, offset))
                ranks[n] = ranks.get(n, 0) + q * number
                offset += n * q
            sequence += number
    return ranges, sequence


def _placer(keys: np.ndarray, table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            at = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
            first_rank, first, number, offset = table[at].T if len(at) else np.zeros((4, 0), np.int64)
            turn = rank - first_rank
            columns = {n: batch.column(n) for n in batch.schema.names if n != "rank"}
            columns |= {"sequence_id": pa.array(first + turn % np.maximum(number, 1)), "offset": pa.array(offset + length * (turn // np.maximum(number, 1)))}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Tokenizes documents, cuts those longer than capacity, and packs the pieces into few sequences.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and with with_ids the ids.
    Null text reads as empty (one piece: end_id). Every row is a document of its own, also where rows or doc_ids repeat
    or doc_id is null. An empty table gives no rows; columns other than doc_id and text are ignored.
    """
    spark = docs.sparkSession
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    pieces = materialize(in_arrow(docs.select("doc_id", "text"), _piece_maker(tokenizer_path, capacity, end_id, with_ids), schema), "pack-pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    ranges, _ = plan(histogram, capacity)
    ranges.sort()
    keys = np.array([(n << 48) + r for n, r, *_ in ranges], dtype=np.int64)
    table = np.array([r[1:] for r in ranges], dtype=np.int64).reshape(-1, 4)
    # Ranks within a length: its salts are counted first, so that a frequent length isn't one task's.
    salts = shuffle_partitions(spark)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    base = counts.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("base"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("i", F.row_number().over(inside) - 1).join(base, ["length", "salt"])
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    return in_arrow(ranked.select(*names, (F.col("base") + F.col("i")).alias("rank")), _placer(keys, table), f"{schema}, sequence_id long, offset long")
