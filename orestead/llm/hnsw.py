"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Vectors are dealt to shards of a bounded size. Where they gather round middles, a shard holds what is nearest to one
middle, and a query meets only the shards of its nearest middles: as many as the exact neighbours of some queries need.
Where they don't, shards go by a hash of the id, and every query meets each. In a shard, equal vectors are one node. Nodes get a
level with a geometric distribution; on each level every node keeps up to DEGREE (twice that on the lowest) neighbours,
chosen with the usual diversity rule among its nearest nodes and then made mutual. The graph is stored as flat arrays:
neighbours level by level, -1 where there is none. All queries of a block descend together, and the shards' results
are merged by exact score. For largest inner products, vectors get one more component that makes all norms of the
shard equal, so that the nearest in Euclidean distance has the largest product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, in_arrow, int_lists, materialize, mix, ship

SHARD_SIZE = 4096
DEGREE = 16
CANDIDATES = 64
EF = 96
QUERY_BLOCK = 2048
#: Numbers in the rows that middles are learnt from, and rows for a middle at least; queries whose exact neighbours are found.
FIT_NUMBERS, FIT_EACH, FIT_QUERIES = 1 << 20, 8, 256
#: The share of those neighbours that the shards met must hold. Fewer shards than FEW, or a larger part of them to meet than MOST: all are met.
COVERED, FEW, MOST = 0.99, 8, 0.75
_STEP = 256
#: Columns looked at for a bound are one in so many; nodes that a query expands in a step.
_SPARSE = 8
_WIDE = 8


def usable(c: Column) -> Column:
    """Neither null, empty nor all zero, and without null or non-finite components."""
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(~bad & F.exists(c, lambda x: x != 0), F.lit(False))


def _scaled(x: np.ndarray, axis: int | None = None) -> np.ndarray:
    """x times a power of two, for all or by row, that puts its largest component under 1: float32 can't overflow."""
    _, power = np.frexp(np.abs(x).max(axis=axis, keepdims=True))
    return np.ldexp(x, -power)


def _largest(value: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """(rows, k): where the k largest of each row are, not in order and without the row's own place.

    The k-th largest of every _SPARSE-th column bounds the k-th largest of all from below, so only the few that reach
    it are partitioned.
    """
    value[np.arange(len(value)), own] = -np.inf
    some = value[:, ::_SPARSE]
    if some.shape[1] <= 2 * k:
        return np.argpartition(-value, k - 1, axis=1)[:, :k]
    bound = np.partition(some, some.shape[1] - k, axis=1)[:, some.shape[1] - k]
    row, column = np.divmod(np.flatnonzero(value >= bound[:, None]), value.shape[1])
    count = np.bincount(row, minlength=len(value))
    place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    reach = np.full((len(value), count.max()), -np.inf, dtype=value.dtype)
    reach[row, place] = value[row, column]
    at = np.zeros(reach.shape, dtype=np.int64)
    at[row, place] = column
    return np.take_along_axis(at, np.argpartition(-reach, k - 1, axis=1)[:, :k], 1)


def _select(points: np.ndarray, members: np.ndarray, degree: int) -> np.ndarray:
    """(members, degree): diverse nearest neighbours of each member among the members, by blocked exact distances."""
    n = len(members)
    out = np.full((n, degree), -1, dtype=np.int32)
    if n < 2:
        return out
    x = points[members]
    square = (x * x).sum(1)
    # left[a] @ right[b] is the product less half of b's square: the larger, the nearer is b to a.
    left, right = np.concatenate([x, np.ones((n, 1), x.dtype)], 1), np.concatenate([x, -square[:, None] / 2], 1)
    k = min(CANDIDATES, n - 1)
    for lo in range(0, n, _STEP):
        hi = min(lo + _STEP, n)
        near = _largest(left[lo:hi] @ right.T, np.arange(lo, hi), k)
        own = square[near] - 2 * np.matmul(left.take(near, axis=0), right[lo:hi, :, None])[:, :, 0]
        near = np.take_along_axis(near, np.argsort(own, axis=1, kind="stable"), 1)
        v = left.take(near, axis=0)
        nearer = np.matmul(v, right.take(near, axis=0).transpose(0, 2, 1)) > np.matmul(v, right[lo:hi, :, None])
        taken, count = np.zeros((hi - lo, k), dtype=bool), np.zeros(hi - lo, dtype=int)
        for j in range(k):
            # A candidate nearer to one already taken than to the node itself is passed over.
            taken[:, j] = ~(taken & nearer[:, j]).any(1) & (count < degree)
            count += taken[:, j]
        for j in range(k):  # fill up with the nearest of those passed over
            taken[:, j] |= taken.sum(1) < degree // 2
        rank = np.cumsum(taken, 1) - 1
        q, j = np.nonzero(taken)
        out[lo + q, rank[q, j]] = members[near[q, j]]
    return out


def _mutual(members: np.ndarray, links: np.ndarray, points: np.ndarray, degree: int, n: int) -> np.ndarray:
    """Adds each link's reverse; a node with too many keeps the nearest."""
    own = np.repeat(members, links.shape[1])
    other = links.ravel()
    own, other = own[other >= 0].astype(np.int64), other[other >= 0].astype(np.int64)
    a, b = np.concatenate([own, other]), np.concatenate([other, own])
    pair = np.unique(a * n + b)
    a, b = pair // n, pair % n
    gap = points.take(a, axis=0)
    gap -= points.take(b, axis=0)
    gap = np.einsum("ij,ij->i", gap, gap)
    order = np.lexsort((gap, a))
    a, b = a[order], b[order]
    first = np.searchsorted(a, np.arange(n))
    rank = np.arange(len(a)) - first[a]
    keep = rank < degree
    out = np.full((n, degree), -1, dtype=np.int32)
    out[a[keep], rank[keep]] = b[keep]
    return out


def build(vectors: np.ndarray, seed: int = 0) -> dict[str, np.ndarray]:
    """The graph over distinct vectors: flat neighbours, first position and width of each level, entry node."""
    n, vectors = len(vectors), _scaled(vectors)
    norm = (vectors * vectors).sum(1)
    points = np.concatenate([vectors, np.sqrt(np.maximum(norm.max() - norm, 0))[:, None]], 1).astype(np.float32)
    level = np.floor(-np.log(np.random.default_rng(seed).random(n) + 1e-12) / math.log(DEGREE)).astype(int)
    top = int(level.max())
    flat, first, width = [], [0], []
    for at in range(top + 1):
        members = np.flatnonzero(level >= at)
        degree = DEGREE * (2 if at == 0 else 1)
        links = _mutual(members, _select(points, members, DEGREE), points, degree, n)
        flat.append(links.ravel())
        first.append(first[-1] + links.size)
        width.append(degree)
    return {"neighbours": np.concatenate(flat), "first": np.array(first), "width": np.array(width), "entry": np.array([int(np.flatnonzero(level == top)[0])])}


def search(vectors: np.ndarray, graph: dict[str, np.ndarray], queries: np.ndarray, ef: int) -> np.ndarray:
    """(queries, ef): nodes found, by largest inner product first; -1 where there are fewer. Queries go in step."""
    n, nq = len(vectors), len(queries)
    v, q = _scaled(vectors).astype(np.float32), _scaled(queries, 1).astype(np.float32)
    width, first, flat = graph["width"], graph["first"], graph["neighbours"]
    table = [flat[first[i] : first[i + 1]].reshape(n, width[i]) for i in range(len(width))]
    rows = np.arange(nq)
    best = np.full(nq, graph["entry"][0])
    score = (v[best] * q).sum(1)
    for links in table[:0:-1]:
        moving = np.ones(nq, dtype=bool)
        while moving.any():
            r = rows[moving]
            near = links[best[r]]
            s = np.einsum("qmd,qd->qm", v[near], q[r])
            s[near < 0] = -np.inf
            j = s.argmax(1)
            better = s[np.arange(len(r)), j] > score[r]
            moving[:] = False
            hit = r[better]
            best[hit], score[hit] = near[better, j[better]], s[better, j[better]]
            moving[hit] = True
    node = np.full((nq, ef), -1)
    value = np.full((nq, ef), -np.inf, dtype=np.float32)
    open_ = np.zeros((nq, ef), dtype=bool)
    node[:, 0], value[:, 0], open_[:, 0] = best, score, True
    seen = np.full(nq * n, -1, dtype=np.int32)
    seen[rows * n + best] = 0
    active, wide = rows, min(_WIDE, ef)
    while len(active):
        candidate = np.where(open_[active], value[active], -np.inf)
        j = np.argpartition(-candidate, wide - 1, axis=1)[:, :wide]
        going = np.take_along_axis(candidate, j, 1) > -np.inf
        some = going.any(1)
        active, j, going = active[some], j[some], going[some]
        if not len(active):
            break
        open_[active[:, None], j] = False
        near = np.where(going[:, :, None], table[0][node[active[:, None], j]], -1).reshape(len(active), -1)
        # What two of the expanded nodes share is taken once: at the place that is written last.
        place = np.flatnonzero(near.ravel() >= 0)
        key = active[place // near.shape[1]] * n + near.ravel()[place]
        new = seen[key] < 0
        place, key = place[new], key[new]
        seen[key] = place
        once = seen[key] == place
        place = place[once]
        s = np.full(near.shape, -np.inf, dtype=np.float32)
        s.ravel()[place] = np.einsum("ij,ij->i", v.take(near.ravel()[place], axis=0), q.take(active[place // near.shape[1]], axis=0))
        all_node = np.concatenate([node[active], near], 1)
        all_value = np.concatenate([value[active], s], 1)
        all_open = np.concatenate([open_[active], s > -np.inf], 1)
        top = np.argpartition(-all_value, ef - 1, axis=1)[:, :ef]
        node[active], value[active], open_[active] = (np.take_along_axis(x, top, 1) for x in (all_node, all_value, all_open))
    node = np.where(np.isfinite(value), node, -1)
    return np.take_along_axis(node, np.argsort(-value, axis=1, kind="stable"), 1)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


class Route:
    """Which shards a row lies in and a query meets: those of the middles nearest to it.

    Rows are put on a sphere by one more component, as for the graphs, of the norm that 99 % of the sample keep. Rows much
    longer than that have large products in many directions; they lie apart, as after the last middle, and all queries
    meet them.
    """

    LONG = 1.5

    def __init__(self, sample: np.ndarray, cells: int):
        self.dim, self.top = sample.shape[1], (1.0, 0)
        norm, power = self._norm(sample)[1:]
        at = np.lexsort((norm, power))[(len(norm) - 1) * 99 // 100]
        self.top = float(norm[at]), int(power[at])
        points = self._place(sample)[0]
        self.middles = points[np.random.default_rng(0).choice(len(points), cells, replace=False)]
        for _ in range(8):
            cell = self._order(points, 1)[:, 0]
            count = np.bincount(cell, minlength=cells)
            total = np.zeros(self.middles.shape)
            np.add.at(total, cell, points)
            self.middles[count > 0] = (total[count > 0] / count[count > 0, None]).astype(np.float32)

    @staticmethod
    def _norm(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of length 1, and their lengths as fractions and powers of two."""
        small = _scaled(x, 1)
        norm, more = np.frexp(np.sqrt((small * small).sum(1)))
        return small / np.ldexp(norm, more)[:, None], norm, more + np.frexp(np.abs(x).max(1))[1]

    def _place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Points on the sphere, and which rows are long."""
        unit, norm, power = self._norm(x)
        length = np.ldexp(norm / self.top[0], np.clip(power - self.top[1], -99, 99))
        r = np.minimum(length, 1)[:, None]
        return np.concatenate([unit * r, np.sqrt(1 - r * r)], 1).astype(np.float32), length > self.LONG

    def _order(self, points: np.ndarray, n: int) -> np.ndarray:
        """(points, n): the nearest middles, nearest first."""
        score = points @ self.middles.T - (self.middles * self.middles).sum(1) / 2
        if n == 1:
            return score.argmax(1)[:, None]
        return np.argsort(-score, axis=1, kind="stable")[:, :n]

    def cells(self, x: np.ndarray) -> np.ndarray:
        points, long = self._place(x)
        return np.where(long, len(self.middles), self._order(points, 1)[:, 0])

    def ranked(self, queries: np.ndarray) -> np.ndarray:
        unit, n = self._norm(queries)[0], len(self.middles)
        order = self._order(np.concatenate([unit, np.zeros((len(unit), 1))], 1).astype(np.float32), n)
        return np.concatenate([np.full((len(unit), 1), n), order], 1)

    def split(self, rows: np.ndarray, met: int, shard_size: int) -> None:
        """Sets how many middles a query meets; a middle with too many rows has several shards, by a hash of the id."""
        self.rows, self.met, self.shard_size = rows, met, shard_size
        self.shards = np.maximum(1, np.round(rows / shard_size)).astype(np.int64)
        self.first = np.cumsum(self.shards) - self.shards

    def deal(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cell = self.cells(_matrix(b.column("vector"), self.dim))
                part = mix(b.column("vec_id").to_numpy().astype(np.uint64)) % self.shards[cell].astype(np.uint64)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array((self.first[cell] + part.astype(np.int64)).astype(np.int32))], [*b.schema.names, "shard"])

    def meet(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                order = self.ranked(_matrix(b.column("vector"), self.dim))
                # Further middles follow until the rows of a whole shard are met, or all.
                before = np.cumsum(self.rows[order], 1) - self.rows[order]
                take = ((np.arange(order.shape[1]) < self.met) | (before < self.shard_size)) & (self.rows[order] > 0)
                row, at = np.nonzero(take)
                cell = order[row, at]
                n = self.shards[cell]
                shard = np.repeat(self.first[cell] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                bounds = np.concatenate([[0], np.cumsum(np.bincount(row, n, len(order)).astype(np.int64))])
                yield pa.RecordBatch.from_arrays([*b.columns, int_lists(shard.astype(np.int32), bounds)], [*b.schema.names, "shards"])


def _exact(route: Route, ids: np.ndarray, queries: np.ndarray, k: int):
    """The k nearest of each query in a partition, with their middles; under query -1 the rows of each middle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = np.zeros(len(route.middles) + 1, dtype=np.int64)
        best = [np.full((len(ids), k), x) for x in (-np.inf, -1, -1)]
        for b in batches:
            if not b.num_rows:
                continue
            x, own = _matrix(b.column("vector"), route.dim), b.column("vec_id").to_numpy()
            cell = route.cells(x)
            rows += np.bincount(cell, minlength=len(rows))
            score = queries @ x.T
            score[ids[:, None] == own[None, :]] = -np.inf
            at = np.argpartition(-score, min(k, len(own)) - 1, axis=1)[:, :k]
            new = np.take_along_axis(score, at, 1), own[at], cell[at]
            both = [np.concatenate([a, n], 1) for a, n in zip(best, new, strict=True)]
            top = np.argpartition(-both[0], k - 1, axis=1)[:, :k]
            best = [np.take_along_axis(x, top, 1) for x in both]
        q, j = np.nonzero(best[0] > -np.inf)
        some = np.flatnonzero(rows)
        columns = (np.concatenate([q, np.full(len(some), -1)]), np.concatenate([best[1][q, j], some]), np.concatenate([best[0][q, j], rows[some]]), np.concatenate([best[2][q, j], some]))
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(t)) for c, t in zip(columns, ("i4", "i8", "f8", "i4"), strict=True)], ["query", "vec_id", "score", "cell"])

    return run


def plan_route(rows: DataFrame, asked: DataFrame, k: int, shard_size: int = SHARD_SIZE) -> Route | None:
    """The route if queries need to meet only a part of the shards; None if all are to be met.

    Middles are learnt from a sample of at most about FIT_NUMBERS numbers. How many of them a query meets is measured: the
    exact neighbours of about FIT_QUERIES queries are found among all rows, and COVERED of them must lie in what is met.
    """
    n, least, most = rows.agg(F.count(F.lit(1)), F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if n <= FEW * shard_size or least != most:
        return None

    def some(df: DataFrame, most_rows: int, total: int) -> pa.Table:
        at = F.pmod(F.xxhash64(F.lit(2), "vec_id", "vector"), F.lit(1 << 30))
        return df.where(at < F.lit(int(min(1, most_rows / total) * (1 << 30)))).select("vec_id", "vector").toArrow()

    ours = asked.where(F.size("vector") == least)
    total = ours.count()
    if not total:
        return None
    tried = some(ours, FIT_QUERIES, total).combine_chunks()
    fit = some(rows, max(FIT_NUMBERS // least, 1), n).combine_chunks()
    if not tried.num_rows or not fit.num_rows:
        return None
    sample = np.unique(_matrix(fit.column("vector").combine_chunks(), least), axis=0)
    cells = min(math.ceil(n / shard_size), len(sample) // FIT_EACH)
    if cells < 2:
        return None
    route = Route(sample, cells)
    ids, queries = tried.column("vec_id").to_numpy(), _matrix(tried.column("vector").combine_chunks(), least)
    found = materialize(in_arrow(rows.select("vec_id", "vector"), _exact(route, ids, queries, k), "query int, vec_id long, score double, cell int"), "hnsw-exact")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    near = found.where("query >= 0").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query", "cell").collect()
    count = np.zeros(cells + 1, dtype=np.int64)
    for r in found.where("query < 0").groupBy("cell").agg(F.sum("score").alias("rows")).collect():
        count[r["cell"]] = r["rows"]
    discard(found)
    place = np.argsort(route.ranked(queries), axis=1)
    held = np.cumsum(np.bincount(np.array([place[r["query"], r["cell"]] for r in near], dtype=int), minlength=cells + 1))
    met = int(np.searchsorted(held, COVERED * held[-1])) + 1
    if met > MOST * cells:
        return None
    route.split(count, met, shard_size)
    return route


def _indexer(keep: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        raw = np.stack(pdf["vector"].to_numpy()).astype(np.float64)
        distinct, node = np.unique(raw, axis=0, return_inverse=True)
        node = node.ravel()
        ids = pdf["vec_id"].to_numpy()
        # Of equal vectors only the smallest ids can be among the nearest: one more than asked for, as a query may be one.
        rank = pd.Series(node).groupby(node).cumcount().to_numpy()
        kept = rank < keep
        graph = build(distinct)
        pack = lambda x, t: np.ascontiguousarray(x, dtype=t).tobytes()
        return pd.DataFrame(
            {
                "shard": [int(pdf["shard"].iloc[0])], "dim": [raw.shape[1]], "nodes": [len(distinct)], "vectors": [pack(distinct, "<f8")],
                "ids": [pack(ids[kept], "<i8")], "node_of": [pack(node[kept], "<i8")],
                **{k: [pack(v, "<i4" if k == "neighbours" else "<i8")] for k, v in graph.items()},
            }
        )

    return run


INDEX = "shard int, dim int, nodes long, vectors binary, ids binary, node_of binary, neighbours binary, first binary, width binary, entry binary"


def build_index(rows: DataFrame, shard_size: int = SHARD_SIZE, keep: int = 21, route: Route | None = None) -> DataFrame:
    """A row per shard with its vectors and flat graph arrays, from rows of vec_id and vector (usable ones).

    The number of shards follows the number of rows, so that a shard's arrays stay bounded.
    """
    ship(rows.sparkSession)
    if route is None:
        shards = max(1, math.ceil(rows.count() / shard_size))
        dealt = rows.withColumn("shard", (F.size("vector") * F.lit(shards) + F.pmod(F.xxhash64("vec_id"), F.lit(shards))).cast("int"))
    else:
        dealt = in_arrow(rows, route.deal, "vec_id long, vector array<double>, shard int")
    return dealt.groupBy("shard").applyInPandas(_indexer(keep), INDEX)


def _searcher(k: int, ef: int):
    def run(key: tuple, index: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "asked": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(index) or not len(block):
            return empty
        row = index.iloc[0]
        n, dim = int(row["nodes"]), int(row["dim"])
        vectors = np.frombuffer(row["vectors"], "<f8").reshape(n, dim)
        graph = {c: np.frombuffer(row[c], "<i4" if c == "neighbours" else "<i8") for c in ("neighbours", "first", "width", "entry")}
        ids, node_of = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["node_of"], "<i8")
        order = np.argsort(node_of, kind="stable")
        ids, node_of = ids[order], node_of[order]
        start, stop = np.searchsorted(node_of, np.arange(n)), np.searchsorted(node_of, np.arange(n), side="right")
        block = block[block["vector"].map(len) == dim]
        parts = [empty]
        for lo in range(0, len(block), _STEP):
            part = block.iloc[lo : lo + _STEP]
            q = np.stack(part["vector"].to_numpy()).astype(np.float64)
            found = search(vectors, graph, q, max(ef, k + 1))
            own, asked = part["vec_id"].to_numpy(), part["asked"].to_numpy()
            row, column = np.nonzero(found >= 0)
            nodes = found[row, column]
            score = (vectors[nodes] * q[row]).sum(1)
            size = stop[nodes] - start[nodes]
            at = np.repeat(start[nodes] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            row, vec, value = np.repeat(row, size), ids[at], np.repeat(score, size)
            other = vec != own[row]
            row, vec, value = row[other], vec[other], value[other]
            order = np.lexsort((vec, -value, row))
            count = np.bincount(row, minlength=len(q))
            best = order[np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) < k]
            parts.append(pd.DataFrame({"query_id": own[row[best]], "asked": asked[row[best]], "vec_id": vec[best], "score": value[best]}))
        return pd.concat(parts, ignore_index=True)

    return run


def nearest(rows: DataFrame, queries: DataFrame, k: int = 20, ef: int = EF, shard_size: int = SHARD_SIZE) -> DataFrame:
    """For each of queries (vec_id, vector) the k rows found with the largest inner product, except its own id.

    Returns query_id, rank (from 1), vec_id and score, the inner product of the original vectors in double precision;
    nearest first, ties to the smaller vec_id. Null ids and vectors that aren't usable() take no part, vectors of another
    length than a query's have no product with it, and shards hold one length each. Rows that repeat an id and a vector
    count once; rows of one id with several vectors are candidates each, and as queries each is answered with ranks of its
    own. Fewer rows than k give all there are. Each shard meets its queries in blocks, as grouped tasks.
    """
    ok = lambda df: df.where(usable(F.col("vector")) & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"))
    rows = materialize(ok(rows).dropDuplicates(["vec_id", "vector"]), "hnsw-rows")
    asked = materialize(ok(queries).dropDuplicates(["vec_id", "vector"]).withColumn("asked", F.xxhash64("vector")), "hnsw-queries")
    route = plan_route(rows, asked, k, shard_size)
    index = materialize(build_index(rows, shard_size, k + 1, route), "hnsw")
    discard(rows)
    if route is None:
        shards = [r["shard"] for r in index.select("shard").collect()]
        met = asked.select("*", F.explode(F.lit(shards) if shards else F.array().cast("array<int>")).alias("shard"))
    else:
        met = in_arrow(asked.where(F.size("vector") == route.dim), route.meet, "vec_id long, vector array<double>, asked long, shards array<int>")
        met = met.select("vec_id", "vector", "asked", F.explode("shards").alias("shard"))
    blocks = materialize(met.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("blocks")), "hnsw-blocks")
    asked = met.join(F.broadcast(blocks), "shard").withColumn("block", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.col("blocks")).cast("int")).drop("blocks")
    spread = index.join(F.broadcast(blocks), "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    found = spread.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(_searcher(k, ef), "query_id long, asked long, vec_id long, score double")
    best = Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
