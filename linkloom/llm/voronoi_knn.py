"""Exact top-k search by a Voronoi kNN join, for the inner product of integer vectors.

Pivots are a sample of the vectors that grows with the root of their number.  Each vector belongs to the cell of its nearest
pivot; a cell's summary is its size, radius, greatest and least norm, and greatest angle to the pivot.  Queries are grouped by
pivots of their own, some 256 to a group, and a group travels as one row.  For a query q and a cell of pivot p and radius
r, scores are at most <q,p> + |q| r, and at most |q| times the greatest norm times the cosine of what the angle between q and
p leaves after the cell's angle.  So

1. each group goes to one block of the cell that its queries find most promising, which gives first k-th scores;
2. it goes, with just those of its queries, to the blocks of just those cells whose upper bound reaches the better of that
   score and the k-th lower bound from the summaries; a block returns only candidates that reach it, at most k a query.

As queries are few against the data, it is groups of queries that are replicated to the cells that need them.  Large
cells are cut into blocks of about `block_rows` vectors, so a hot cell (say, one very common vector) is spread out.  A task
keeps one block in memory and streams the groups past it.

Defined results: each component x becomes floor(256 x) as double.  Vectors that are null or hold null or non-finite
components take no part; vectors of different lengths have no score.  Ties go to the smaller id, null ids last; an equal row
is a candidate like any other, but a query's own id is never its candidate.  A query row given twice is one query; rows of one id
with different vectors share one ranking.  Components and scores beyond 62 and 64 bits are cut to that range.  Rows with a null
id are candidates, never queries.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm import common as C

#: Sampled pivots: the root of the number of vectors, within so many bytes.
PIVOT_BYTES = 1 << 26
BLOCK_ROWS, QUERIES = 20_000, 256
_TYPES = {2: np.dtype("<i2"), 4: np.dtype("<i4"), 8: np.dtype("<i8")}


def quantised(col: pa.Array) -> list[np.ndarray | None]:
    """floor(256 x) of each vector as integers, None for those that take no part."""
    off, x = np.asarray(col.offsets), col.values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
    ok = np.isfinite(x)
    whole = np.clip(np.floor(256.0 * np.where(ok, x, 0.0)), -(2.0**62), 2.0**62).astype(np.int64)
    bad = np.r_[0, np.cumsum(~ok)]
    good = (bad[off[1:]] == bad[off[:-1]]) & col.is_valid().to_numpy(zero_copy_only=False)
    return [whole[s:e] if g else None for g, s, e in zip(good.tolist(), off[:-1].tolist(), off[1:].tolist(), strict=True)]


def packed(v: np.ndarray) -> bytes:
    """The narrowest little-endian integers that hold the vector; the width follows from the length and the dimension."""
    top = int(np.abs(v).max()) if len(v) else 0
    return v.astype(_TYPES[2 if top < 2**15 else 4 if top < 2**31 else 8]).tobytes()


def unpacked(rows: list[bytes], dim: int) -> np.ndarray:
    out = np.empty((len(rows), dim), np.int64)
    for i, r in enumerate(rows):
        if dim:
            out[i] = np.frombuffer(r, _TYPES[len(r) // dim])
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows, in float64 while all sums stay below 2^53, else in Python integers."""
    top = [int(np.abs(x).max()) if x.size else 0 for x in (a, b)]
    if top[0] * top[1] * max(1, a.shape[1]) < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


class Cells:
    """Pivots by dimension, and after summary() the size, radius, norms and angle of each cell."""

    FACTS = ("n", "r", "big", "low", "angle")

    def __init__(self, pivots: dict[int, np.ndarray]):
        self.pivots = pivots
        self.of: dict[int, dict[str, np.ndarray]] = {}
        self.blocks: dict[int, np.ndarray] = {}

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Cell, distance to its pivot, norm, and angle to it of each vector; distance and angle rounded up."""
        x, p = v.astype(np.float64), self.at(v.shape[1])
        d = (x**2).sum(1)[:, None] - 2 * x @ p.T + (p**2).sum(1)
        cell = d.argmin(1)
        far = np.sqrt(((x - p[cell]) ** 2).sum(1)) * (1 + 1e-9) + 1e-6
        return cell, far, np.sqrt((x**2).sum(1)), np.minimum(np.pi, _angle(x, p[cell]) + 1e-6)

    def at(self, dim: int) -> np.ndarray:
        return self.pivots.get(dim, np.zeros((1, dim)))

    def summary(self, rows: list, block_rows: int) -> None:
        """rows: dim, cell and the facts of each cell that has vectors."""
        for dim in {r["dim"] for r in rows}:
            own = {f: np.zeros(len(self.at(dim))) for f in self.FACTS}
            for r in rows:
                if r["dim"] == dim:
                    for f in self.FACTS:
                        own[f][r["cell"]] = r[f]
            self.of[dim] = own
            self.blocks[dim] = np.maximum(1, np.ceil(own["n"] / block_rows)).astype(np.int64)

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of each query in each cell."""
        x, p, c = q.astype(np.float64), self.at(q.shape[1]), self.of[q.shape[1]]
        at, size = x @ p.T, np.sqrt((x**2).sum(1))[:, None]
        far = size * c["r"]
        slack = 1e-9 * (np.abs(at) + far) + 1e-3
        cos = np.cos(np.maximum(0.0, _angle(x[:, None, :], p) - c["angle"]))
        cone = size * np.where(cos > 0, c["big"], c["low"]) * cos
        high = np.minimum(at + far, cone + 1e-6 * size * c["big"]) + slack
        return at - far - slack, np.where(c["n"] > 0, high, -np.inf)

    def floor(self, q: np.ndarray, low: np.ndarray, k: int) -> np.ndarray:
        """Per query, a score that k other vectors reach for sure."""
        size = self.of[q.shape[1]]["n"]
        order = np.argsort(np.where(size > 0, -low, np.inf), axis=1)
        total = np.cumsum(size[order], axis=1)
        enough = total >= k + 1
        first = np.where(enough.any(1), enough.argmax(1), -1)
        got = np.take_along_axis(low, np.take_along_axis(order, np.maximum(first, 0)[:, None], 1), 1)[:, 0]
        return np.where(first >= 0, got, -np.inf)

    def needed(self, q: np.ndarray, theta: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Which cells each query needs, and the score that a candidate must reach."""
        low, high = self.bounds(q)
        least = np.maximum(self.floor(q, low, k), theta)
        return high >= least[:, None], least


def _angle(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The angle between vectors; zero vectors are at a right angle to all."""
    dot = (x * p).sum(-1) if x.ndim == 2 else x[:, 0, :] @ p.T
    both = np.sqrt((x**2).sum(-1) * (p**2).sum(-1))
    return np.arccos(np.clip(np.divide(dot, both, out=np.zeros_like(dot), where=both > 0), -1.0, 1.0))


_ROW = "dim int, cell int, block int, kind int, id long, v binary"
_NAMES = ["dim", "cell", "block", "kind", "id", "v"]


def _rows(dim, cell, block, kind, ids, v) -> pa.RecordBatch:
    n = len(ids)
    col = lambda x, t: pa.array(np.full(n, x) if np.isscalar(x) else x, t)
    return pa.RecordBatch.from_arrays([col(dim, pa.int32()), col(cell, pa.int32()), col(block, pa.int32()), col(kind, pa.int32()), pa.array(ids, pa.int64()), pa.array(v, pa.binary())], _NAMES)


def pack_group(ids: np.ndarray, theta: np.ndarray, q: np.ndarray) -> bytes:
    return ids.astype("<i8").tobytes() + theta.astype("<f8").tobytes() + packed(q.ravel())


def unpack_group(raw: bytes, n: int, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, theta and vectors of a group of n queries."""
    rest = raw[16 * n :]
    return np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "<f8", n, 8 * n), np.frombuffer(rest, _TYPES[len(rest) // (n * dim)] if dim else np.int64).astype(np.int64).reshape(n, dim)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, list]]:
    v = batch.column("v").to_pylist()
    dims = C.longs(batch, "dim")
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        yield dim, at, [v[i] for i in at.tolist()]


def _solver(k: int):
    """Over partitions sorted by (dim, cell, block, kind): the block's vectors (kind 0), then groups of queries (kind 1)."""
    names = ["query_id", "vec_id", "score"]

    def best(q_ids, theta, q, ids, x):
        s = products(q, x)
        out: list[list[np.ndarray]] = [[], [], []]
        for i in range(len(q_ids)):
            ok = np.flatnonzero((s[i] >= theta[i]) & (ids != q_ids[i]))
            if len(ok) > k:
                kth = np.partition(s[i][ok], len(ok) - k)[len(ok) - k]
                ok = ok[s[i][ok] >= kth]
                ok = ok[np.lexsort((ids[ok], -s[i][ok]))[:k]]
            for c, part in zip(out, (np.full(len(ok), q_ids[i]), ids[ok], s[i][ok]), strict=True):
                c.append(part)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names)

    def run(batches):
        key, ids, vecs, x = None, [], [], None
        for b in batches:
            keys = np.stack([C.longs(b, c) for c in ("dim", "cell", "block", "kind")], 1)
            cut = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
            for s, e in zip(cut.tolist(), np.r_[cut[1:], len(keys)].tolist(), strict=True):
                part, mine = b.slice(s, e - s), tuple(keys[s][:3].tolist())
                if mine != key:
                    key, ids, vecs, x = mine, [], [], None
                if keys[s][3] == 0:
                    ids.append(C.longs(part, "id"))
                    vecs.append(unpacked(part.column("v").to_pylist(), mine[0]))
                elif ids:
                    if x is None:
                        all_ids, x = np.concatenate(ids), np.concatenate(vecs)
                    for n, raw in zip(C.longs(part, "id").tolist(), part.column("v").to_pylist(), strict=True):
                        yield best(*unpack_group(raw, n, mine[0]), all_ids, x)

    return run


def _pivots(vectors: DataFrame, n: int) -> dict[int, np.ndarray]:
    """By dimension, the distinct vectors among the n of least hash: a random choice that reruns repeat."""
    picked = vectors.orderBy(F.xxhash64("id", "v"), "id").limit(n).collect()
    return {d: np.unique(unpacked([r["v"] for r in picked if r["dim"] == d], d).astype(np.float64), axis=0) for d in {r["dim"] for r in picked}}


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, n_pivots: int | None = None, block_rows: int = BLOCK_ROWS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by `every`, against all rows."""
    spark = vectors.sparkSession
    n = C.partitions(spark)
    src = C.pick(vectors, id=id_col, v=vec_col).select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<double>").alias("v"))

    def encode(batches):
        for b in batches:
            for i in range(0, b.num_rows, 2048):
                part = b.slice(i, 2048)
                vs = quantised(part.column("v"))
                at = [j for j, v in enumerate(vs) if v is not None]
                ids = part.column("id").take(pa.array(at, pa.int32()))
                ids = ids.fill_null(C.NO_ID)
                yield pa.RecordBatch.from_arrays([pa.array([len(vs[j]) for j in at], pa.int32()), ids, pa.array([packed(vs[j]) for j in at], pa.binary())], ["dim", "id", "v"])

    base = C.stored(src.mapInArrow(encode, "dim int, id long, v binary"), "vectors")
    queries = base.where((F.col("id") % every == 0) & (F.col("id") != C.NO_ID)).dropDuplicates(["id", "v"])
    rows, widest, asked = (r := base.agg(F.count("*"), F.max("dim"), F.count(F.when((F.col("id") % every == 0) & (F.col("id") != C.NO_ID), 1))).first())[0], r[1] or 1, r[2]
    most = max(1, PIVOT_BYTES // (8 * max(1, widest)))
    cells = Cells(_pivots(base, min(most, n_pivots or math.isqrt(rows) + 1)))
    groups = Cells(_pivots(queries, min(most, asked // QUERIES + 1)))

    def assign(batches):
        for b in batches:
            ids = C.longs(b, "id")
            for dim, at, v in _by_dim(b):
                cell, *facts = cells.nearest(unpacked(v, dim))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), dim), pa.int32()), pa.array(cell, pa.int32()), pa.array(ids[at]), pa.array(v, pa.binary()), *map(pa.array, facts)], ["dim", "cell", "id", "v", "far", "norm", "angle"])

    data = C.stored(base.mapInArrow(assign, "dim int, cell int, id long, v binary, far double, norm double, angle double"), "cells")
    facts = data.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("far").alias("r"), F.max("norm").alias("big"), F.min("norm").alias("low"), F.max("angle").alias("angle"))
    cells.summary(facts.collect(), block_rows)  # a row a cell

    def place(batches):
        """Data rows get a block of their cell, by a hash of their number."""
        for b in batches:
            ids = C.longs(b, "id")
            for dim, at, v in _by_dim(b):
                cell = C.longs(b, "cell")[at]
                own = ids[at]
                h = ((own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
                yield _rows(dim, cell, h % cells.blocks[dim][cell], 0, own, v)

    def of_group(batches):
        """Queries with the number of their group's pivot."""
        for b in batches:
            ids = C.longs(b, "id")
            for dim, at, v in _by_dim(b):
                yield _rows(dim, groups.nearest(unpacked(v, dim))[0], 0, 0, ids[at], v)

    own = C.stored(queries.mapInArrow(of_group, _ROW), "queries")
    cuts = own.groupBy("dim", "cell").agg(F.ceil(F.count("*") / (2 * QUERIES)).cast("int").alias("cuts"))
    own = own.join(cuts, ["dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int")).select(*_NAMES)

    def grouped(send):
        """Over queries sorted by group: the rows that send(dim, ids, theta, q) gives for each group."""

        def run(batches):
            now, held = None, []

            def done():
                dim = now[0]
                ids, theta = (np.concatenate([x[i] for x in held]) for i in (0, 1))
                return send(dim, ids, theta, np.concatenate([x[2] for x in held]))

            for b in batches:
                keys = np.stack([C.longs(b, c) for c in ("dim", "cell", "block")], 1)
                cut = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])[: b.num_rows]
                for s, e in zip(cut.tolist(), [*cut[1:].tolist(), b.num_rows], strict=True) if len(cut) else ():
                    mine, part = tuple(keys[s].tolist()), b.slice(s, e - s)
                    if held and mine != now:
                        yield from done()
                        held = []
                    now = mine
                    theta = part.column("theta").to_numpy(zero_copy_only=False).astype(np.float64)
                    held.append((C.longs(part, "id"), np.where(np.isnan(theta), -np.inf, theta), unpacked(part.column("v").to_pylist(), mine[0])))
            if held:
                yield from done()

        return run

    def first(dim, ids, theta, q):
        """The group to one block of the cell of the highest sum of its middles."""
        low, high = cells.bounds(q)
        cell = int(np.where(cells.of[dim]["n"] > 0, q.astype(np.float64).sum(0) @ cells.at(dim).T, -np.inf).argmax())
        yield _rows(dim, cell, int(ids[0] % cells.blocks[dim][cell]), 1, [len(ids)], [pack_group(ids, cells.floor(q, low, k), q)])

    def needed(dim, ids, theta, q):
        """Those queries that need a cell to each of its blocks."""
        need, least = cells.needed(q, theta, k)
        for c in np.flatnonzero(need.any(0)).tolist():
            at = np.flatnonzero(need[:, c])
            times = int(cells.blocks[dim][c])
            yield _rows(dim, c, np.arange(times), 1, [len(at)] * times, [pack_group(ids[at], least[at], q[at])] * times)

    def solve(asks: DataFrame, send) -> DataFrame:
        dealt = asks.repartition(n, "dim", "cell", "block").sortWithinPartitions("dim", "cell", "block", "id").mapInArrow(grouped(send), _ROW)
        both = data.mapInArrow(place, _ROW).unionByName(dealt)
        both = both.repartition(n, "dim", "cell", "block").sortWithinPartitions("dim", "cell", "block", "kind")
        return both.mapInArrow(_solver(k), "query_id long, vec_id long, score long")

    by_score = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    near = solve(own.withColumn("theta", F.lit(None).cast("double")), first)
    kth = near.withColumn("r", F.row_number().over(by_score)).where(F.col("r") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("theta"))
    found = solve(own.join(kth, "id", "left").select(*_NAMES, "theta"), needed)
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    vec = F.when(F.col("vec_id") == C.NO_ID, None).otherwise(F.col("vec_id")).alias("vec_id")
    return ranked.select("query_id", "rank", vec, "score")


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: ids divisible by 50, 5 highest."""
    return top_k(C.table(spark, sf_dir, "embeddings"), every=50, k=5)


def brute(rows: list[tuple], every: int = 50, k: int = 5) -> list[tuple]:
    """For tests: (query_id, rank, vec_id, score) by comparing all."""
    ok = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q is None or q % every:
            continue
        s = sorted(((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in ok if i != q and len(a) == len(b)), key=lambda t: (t[0], t[1] is None, t[1] or 0))
        out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s[:k])]
    return sorted(out)


SQL = {
    "op10_topk_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, coalesce(list_inner_product(q.e, c.e), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
}
