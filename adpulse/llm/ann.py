"""Approximate nearest neighbours by collision counting over single projections.

Vectors are dealt into blocks, and a block into groups of about ``BLOCK`` rows,
each with an index of ``PROJECTIONS`` random lines: the group's projections on
each line in a sorted array.  A query opens a window around its own projection on
every line.  A vector collides with the query on a line if it lies in that window,
and is verified (exact distance) once it collides on ``SHARE`` of the lines.  If
the k-th best distance found is beyond the current radius, the radius grows by
``GROWTH`` and all windows with it (virtual rehashing: the same sorted arrays,
wider windows), until the k-th distance is within the radius or every vector of
the group was verified.  In the block's next group the radius begins where it
covers the k-th distance found so far.  So a vector within the final radius is
missed only if it collides less often than its expected share; there is no cap on
candidates.

A block's vectors are sent to its task once, and all queries pass by in batches of
at most ``QUERIES``; a block's answer is at most k rows per query, and the best k
of all blocks are taken by a ranking window with a partial top-k before the
shuffle.  Memory of a task is one block with its indexes and one batch of queries,
whatever the table.  Blocks grow with the table up to ``COMPONENTS``, so that the
queries are not sent to more blocks than keep a cluster busy.

Vectors that are null, empty, zero, or hold a null or non-finite component take
no part, neither as query nor as candidate; vectors of another length are not
compared.  A query's own row is every row with its ``vec_id``.  Ties go to the
smaller ``vec_id``.  Repeated query rows are answered once each.  With fewer
than k candidates all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import parts_for, stored

BLOCK = 4096
#: Blocks of a table are larger than that only if there are more than so many, and hold so many components at most.
BLOCKS = 32
COMPONENTS = 2 ** 22
QUERIES = 256
PROJECTIONS = 80
#: A window's half width at radius 1, in units of a projected distance.
WIDTH = 1.0
#: A vector at the radius collides with 0.68 of the lines on average.
SHARE = 0.55
GROWTH = 1.2
SEED = 11
#: Queries counted at a time, so that their counts stay in a core's cache.
STEP = 16


class CollisionIndex:
    """Sorted projections of a group of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.lines = np.random.default_rng(SEED).standard_normal((vectors.shape[1], PROJECTIONS))
        projected = vectors @ self.lines
        order = np.argsort(projected, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(projected, order.T, axis=0).T.copy()
        # Each vector's place on each line: it collides if its place lies in a window's range of places.
        self.places = np.empty(order.shape, np.uint16 if len(ids) < 2 ** 16 else np.uint32)
        np.put_along_axis(self.places, order, np.arange(len(ids), dtype=self.places.dtype)[None, :], axis=1)
        self.squares = np.einsum("ij,ij->i", vectors, vectors)
        self.need = int(np.ceil(SHARE * PROJECTIONS))
        # A first radius: small against the group's own spread.
        self.radius = max(float(np.sqrt(vectors.var(axis=0).sum())) / 2, 1e-12)

    def _collides(self, at: np.ndarray, half: np.ndarray) -> np.ndarray:
        """Whether each vector lies in enough of each query's windows."""
        lines = list(zip(self.sorted, at.T, strict=True))
        low = np.stack([s.searchsorted(a - half) for s, a in lines])
        high = np.stack([s.searchsorted(a + half, "right") for s, a in lines])
        # A place below the window wraps around to a large offset.
        kind = self.places.dtype
        width = np.minimum(high - low, np.iinfo(kind).max).astype(kind)[:, :, None]
        low = low.astype(kind)[:, :, None]
        out = np.empty((len(at), len(self.ids)), bool)
        for i in range(0, len(at), STEP):
            part = slice(i, i + STEP)
            counts = np.zeros(out[part].shape, np.uint8)
            offset, hit = np.empty(counts.shape, kind), np.empty(counts.shape, bool)
            for places, lo, wide in zip(self.places, low[:, part], width[:, part], strict=True):
                np.subtract(places, lo, out=offset)
                np.less(offset, wide, out=hit)
                np.add(counts, hit.view(np.uint8), out=counts)
            np.greater_equal(counts, self.need, out=out[part])
        return out

    def search(self, own: np.ndarray, queries: np.ndarray, k: int,
               before: list[list[tuple[float, int]]] | None = None) -> list[list[tuple[float, int]]]:
        """For each query the k nearest found, as (distance, id), without rows of its id ``own``;
        ``before`` holds those found in other groups."""
        best = [list(b) for b in before] if before else [[] for _ in own]
        at = queries @ self.lines
        # Squared distances from one matrix product, which say what lies beyond a radius; exact ones are taken of the rest.
        lengths = np.einsum("ij,ij->i", queries, queries)
        about = self.squares + lengths[:, None] - 2 * (queries @ self.vectors.T)
        slack = 1e-12 * queries.shape[1] * (self.squares.max() + lengths)
        others = self.ids != own[:, None]
        n_others = others.sum(axis=1)
        radius = np.full(len(own), self.radius)
        for i, found in enumerate(best):
            while len(found) >= k and radius[i] < found[k - 1][0]:
                radius[i] *= GROWTH
        active = np.flatnonzero(n_others)
        while len(active):
            hits = self._collides(at[active], WIDTH * radius[active]) & others[active]
            # Once all are verified, the k nearest may lie beyond the radius.
            reach = np.where(hits.sum(axis=1) < n_others[active], radius[active], np.inf)
            # Products beyond the range of numbers rule nothing out.
            hits &= ~(about[active] > (reach * reach + slack[active])[:, None])
            ends = np.zeros(len(active), bool)
            for j, i in enumerate(active.tolist()):
                which = np.flatnonzero(hits[j])
                distance = np.sqrt(((self.vectors[which] - queries[i]) ** 2).sum(axis=1))
                near = distance <= reach[j]
                if near.sum() + sum(d <= reach[j] for d, _ in best[i]) >= min(k, len(best[i]) + n_others[i]):
                    best[i] = heapq.nsmallest(k, best[i] + list(zip(distance[near].tolist(), self.ids[which[near]].tolist(),
                                                                    strict=True)))
                    ends[j] = True
            active = active[~ends]
            radius[active] *= GROWTH
        return best


class Block:
    """The vectors of a block in groups, each with its index."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        groups, cuts = max(1, round(len(ids) / BLOCK)), []
        if groups > 1:
            # A small first group, where the radius grows, bounds the others whatever order the table is in.
            mixed = np.random.default_rng(SEED).permutation(len(ids))
            ids, vectors = ids[mixed], vectors[mixed]
            cuts = np.linspace(BLOCK // 8, len(ids), groups + 1).astype(int)[:-1]
        self.groups = [CollisionIndex(i, v) for i, v in zip(np.split(ids, cuts), np.split(vectors, cuts), strict=True)]

    def search(self, own: np.ndarray, queries: np.ndarray, k: int) -> list[list[tuple[float, int]]]:
        found = None
        for index in self.groups:
            found = index.search(own, queries, k, found)
        return found


def _runs(batch: pa.RecordBatch):
    """Slices of a batch of one (dim, part, asks) each, with that key."""
    keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("dim", "part", "asks")])
    cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:], strict=False):
        yield tuple(keys[:, start].tolist()), batch.slice(start, end - start)


def _matrix(run: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    ids = run.column("vec_id").to_numpy(zero_copy_only=False)
    return ids, run.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1).astype(np.float64)


def _search(k: int):
    """Rows sorted by (dim, part, asks): a block's vectors, then the queries that pass it."""
    def run(batches):
        of, held, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            for (dim, part, asks), rows in _runs(batch):
                if of != (dim, part):
                    of, held, block = (dim, part), [], None
                if not asks:
                    held.append(_matrix(rows))
                    continue
                if held:
                    ids, vectors = zip(*held, strict=True)
                    held, block = [], Block(np.concatenate(ids), np.concatenate(vectors))
                if block is None:  # no vector of this length in the part
                    continue
                for i in range(0, rows.num_rows, QUERIES):
                    asked = rows.slice(i, QUERIES)
                    own, queries = _matrix(asked)
                    found = block.search(own, queries, k)
                    out = [(q, row, v, d) for q, row, near in zip(own.tolist(), asked.column("row").to_pylist(), found, strict=True)
                           for d, v in near]
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(
                        zip(*out, strict=True) if out else [[]] * 4,
                        (pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)],
                        names=["query_id", "row", "vec_id", "score"])
    return run


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``vectors`` (``vec_id,
    embedding``) with ``is_query``, its k nearest other rows by Euclidean distance."""
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    rows = stored(vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                                 F.col("embedding").cast(kind).alias("vector"),
                                 F.monotonically_increasing_id().alias("row"), is_query.alias("is_query"))
                  .filter(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
                  .withColumn("dim", F.size("vector")), "vectors")
    n_rows, dim = rows.agg(F.count(F.lit(1)), F.max("dim")).first()
    per_block = max(BLOCK, min(n_rows // BLOCKS, COMPONENTS // (dim or 1)))
    n_blocks = parts_for(n_rows, per_block)
    columns = ["dim", "part", "asks", "vec_id", "row", "vector"]
    dealt = rows.withColumns({"part": F.pmod(F.xxhash64("row"), F.lit(n_blocks)), "asks": F.lit(False)})
    asked = rows.filter("is_query").withColumns({
        "part": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))), "asks": F.lit(True)})
    # A part is a task: no two share one by chance of a hash.
    found = (dealt.select(*columns).unionByName(asked.select(*columns))
             .repartitionById(n_blocks, F.col("part").cast("int"))
             .sortWithinPartitions("dim", "part", "asks", "row")
             .mapInArrow(_search(k), "query_id long, row long, vec_id long, score double"))
    best = Window.partitionBy("query_id", "row").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
