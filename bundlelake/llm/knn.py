"""Nearest neighbours by block matrix join.

Queries and candidates are dealt over a grid of tiles by an equi-key: every
query goes to each of the G candidate groups, every candidate to each of the
H query groups.  A tile holds its (at most ``QUERIES``) queries and streams
its candidates in blocks.  Each block is an int8 product tile: unit vectors
are rounded to 127 steps, the integer products give approximate cosines, and
the lengths of the rounding errors bound how far off they are.  Pairs whose
upper bound reaches the best lower bounds are recomputed in double precision
and go to a heap per query; the heaps of a query's tiles are merged last.
The result is exact.

Defined cases: vectors that are null, empty, zero or hold a null or
non-finite component, and rows with a null id, take no part; vectors are
compared with those of their length only; of several rows with one id the
smallest vector counts; equal cosines rank by id; a query with fewer than k
candidates gets them all; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERIES = 2048        # queries of a tile
BLOCK = 2048          # candidates of a product
TILES_PER_CORE = 4
RECHECK = 1 << 22     # components recomputed together, whatever the dimension
_SLAB = 1024          # dimensions whose int8 products add up exactly in float32
_ULP = 1e-9           # covers the rounding of the bounds themselves


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col("vec")
    fine = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
            .where(F.col("id").isNotNull() & v.isNotNull()).where(fine & F.exists(v, lambda x: x != 0)))


class _Side:
    """Vectors of one length: originals, norms, int8 steps and error lengths."""

    def __init__(self, ids, x: np.ndarray):
        self.ids, self.x = ids, x / np.abs(x).max(axis=1, keepdims=True)  # cosine ignores length
        self.norm = np.sqrt((self.x * self.x).sum(axis=1))
        unit = self.x / self.norm[:, None]
        self.scale = np.abs(unit).max(axis=1) / 127
        self.steps = np.rint(unit / self.scale[:, None]).astype(np.int8)
        whole = self.steps * self.scale[:, None]
        self.size = np.sqrt((whole * whole).sum(axis=1))
        self.error = np.sqrt(((unit - whole) ** 2).sum(axis=1))


def _product(a: _Side, b: _Side) -> np.ndarray:
    """int8 products, added up exactly."""
    total = np.zeros((len(a.ids), len(b.ids)))
    for d in range(0, a.steps.shape[1], _SLAB):
        total += a.steps[:, d:d + _SLAB].astype(np.float32) @ b.steps[:, d:d + _SLAB].astype(np.float32).T
    return total


class _Tile:
    def __init__(self, k: int):
        self.k, self.queries, self.heaps = k, {}, {}

    def ask(self, dim: int, side: _Side):
        self.queries[dim] = side
        self.heaps[dim] = [[] for _ in side.ids]  # of (score, -id), the worst first

    def see(self, dim: int, c: _Side):
        if dim not in self.queries:
            return
        q, heaps = self.queries[dim], self.heaps[dim]
        near = _product(q, c) * (q.scale[:, None] * c.scale[None, :])
        off = q.size[:, None] * c.error + q.error[:, None] * c.size + q.error[:, None] * c.error + _ULP
        own = q.ids[:, None] == c.ids[None, :]
        low = np.where(own, -np.inf, near - off)
        floor = np.array([h[0][0] if len(h) == self.k else -np.inf for h in heaps])
        if low.shape[1] >= self.k:
            floor = np.maximum(floor, np.partition(low, low.shape[1] - self.k, axis=1)[:, -self.k])
        qi, ci = np.nonzero((near + off >= floor[:, None]) & ~own)
        step = max(1, RECHECK // dim)
        for s in range(0, qi.size, step):
            a, b = qi[s:s + step], ci[s:s + step]
            score = (q.x[a] * c.x[b]).sum(axis=1) / (q.norm[a] * c.norm[b])
            # a query's k best of these, then its heap
            order = np.lexsort((c.ids[b], -score, a))
            place = np.arange(order.size) - np.searchsorted(a[order], a[order])
            best = order[place < self.k]
            for i, pair in zip(a[best].tolist(), zip(score[best].tolist(), (-c.ids[b[best]]).tolist())):
                if len(heaps[i]) < self.k:
                    heapq.heappush(heaps[i], pair)
                elif pair > heaps[i][0]:
                    heapq.heapreplace(heaps[i], pair)

    def found(self) -> pa.RecordBatch:
        rows = [(i, -m, s) for dim, q in self.queries.items() for i, h in zip(q.ids.tolist(), self.heaps[dim]) for s, m in h]
        cols = zip(*rows) if rows else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))],
                                          names=["query_id", "vec_id", "score"])


def _by_length(rows: list[tuple[int, np.ndarray]]):
    for dim in sorted({len(v) for _, v in rows}):
        ids, vecs = zip(*[(i, v) for i, v in rows if len(v) == dim])
        yield dim, _Side(np.array(ids, np.int64), np.array(vecs, float))


def _stream(k: int):
    """Rows come sorted by tile, queries first, then by id and vector."""
    def run(batches):
        tile, now, kind, last, rows = None, None, None, None, []

        def flush():
            for dim, side in _by_length(rows):
                (tile.ask if kind == 0 else tile.see)(dim, side)
            rows.clear()

        for b in batches:
            vecs = b.column(3)
            flat, at = vecs.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(vecs.value_lengths().to_numpy())])
            for r, (t, side, i) in enumerate(zip(*(b.column(c).to_pylist() for c in range(3)))):
                if t != now or side != kind:
                    flush() if rows else None
                    if t != now:
                        if tile is not None:
                            yield tile.found()
                        tile, now = _Tile(k), t
                    kind, last = side, None
                if i == last:
                    continue  # a further row of this id
                last = i
                rows.append((i, flat[at[r]:at[r + 1]]))
                if kind == 1 and len(rows) >= BLOCK:
                    flush()
        if tile is not None:
            flush() if rows else None
            yield tile.found()
    return run


def nearest(queries: DataFrame, candidates: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest cosines among
    the candidates with another id."""
    spark = candidates.sparkSession
    q, c = usable(queries, id_col, vec_col), usable(candidates, id_col, vec_col)
    n = q.count()
    h = max(1, -(-n // QUERIES))
    g = max(1, -(-spark.sparkContext.defaultParallelism * TILES_PER_CORE // h))
    def tiles(own, m, others, stride):
        """The tile of each of the other side's groups."""
        first = F.pmod(F.xxhash64("id"), F.lit(m)) * own
        return F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long")),
                                     lambda j: first + j * stride)).alias("tile")

    vec = F.col("vec").cast("array<double>").alias("vec") if dict(c.dtypes)["vec"] != dict(q.dtypes)["vec"] else F.col("vec")
    rows = (q.select(tiles(g, h, g, 1), F.lit(0).alias("side"), F.col("id").cast("long").alias("id"), vec)
            .unionAll(c.select(tiles(1, g, h, g), F.lit(1).alias("side"), F.col("id").cast("long").alias("id"), vec)))
    dealt = rows.repartition(g * h, "tile").sortWithinPartitions("tile", "side", "id", "vec")
    found = dealt.mapInArrow(_stream(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
