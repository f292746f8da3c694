"""Exact top-k search by inner product with a dual-tree search over cover trees.

Candidates stay where they are: each task builds cover trees over bounded blocks of its own vectors. The
queries, a stated set, come in blocks of bounded size that are broadcast one after the other, each with its
own cover tree. A pair of nodes is pruned when the largest inner product that the two centres and covering
radii allow lies below the worst kth score of all queries in the query node. Each block gives its best k
per query; a window keeps the best k of those, so what is shuffled is k rows per query and block.

The scale of a node's children is the distance that the first ``fan`` centres of a farthest-first choice leave
uncovered, or the node's own divided by ``base``, whichever comes first. Such centres lie further apart than that scale and
cover all else within it, which are a cover tree's invariants, so a node splits into few children at any dimension.
Nodes of at most ``leaf`` vectors (half as many queries) are compared by one matrix product, without the queries that the
row node's own ball rules out.

Defined cases: vectors that are null, or hold null or non-finite components, take no part, and so do rows
without an id; only vectors of the same length are compared; rows with a query's own id are never its
results; equal scores go to the smaller id; repeated rows count each. Scores are exact over the whole range of a long; if
the components would allow one beyond it, an OverflowError is raised.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lessonweave.llm.common import durable, in_arrow

SCALE = 256
K = 5
LEAF = 64
_BLOCK = 8192


class CoverTree:
    """Nodes over rows ``order[lo:hi]``; ``children[i]`` are the nodes that share out the rows of node i.

    A node's own centre is also that of its first child.
    """

    def __init__(self, points: np.ndarray, leaf: int, fan: int = 8, base: float = 1.6):
        n = len(points)
        self.order = np.arange(n)
        self.center: list[int] = []
        self.radius: list[float] = []
        self.range: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        norms = np.einsum("ij,ij->i", points, points)

        def distances(rows: np.ndarray, c: int) -> np.ndarray:
            return np.sqrt(np.maximum(norms[rows] + norms[c] - 2 * (points[rows] @ points[c]), 0))

        def add(lo: int, hi: int, c: int, dist: np.ndarray) -> int:
            self.center.append(c)
            self.radius.append(float(dist.max(initial=0.0)))
            self.range.append((lo, hi))
            self.children.append([])
            waiting.append((len(self.center) - 1, dist))
            return len(self.center) - 1

        waiting: list[tuple[int, np.ndarray]] = []
        if n:
            root = int(np.argmin(norms - 2 * (points @ points.mean(axis=0))))
            add(0, n, root, distances(self.order, root))
        while waiting:
            me, dist = waiting.pop()
            lo, hi = self.range[me]
            if hi - lo <= leaf or not dist.any():
                continue
            rows = self.order[lo:hi]
            centers, away = [self.center[me]], [dist]
            least = dist.copy()
            while len(centers) < fan and least.max() > self.radius[me] / base:
                far = int(least.argmax())
                away.append(distances(rows, rows[far]))
                away[-1][far] = 0
                centers.append(int(rows[far]))
                np.minimum(least, away[-1], out=least)
            # A row may belong to any centre that covers it; those that others cover don't stay with the node's own.
            every = np.stack(away)
            other = every[1:].argmin(axis=0) + 1
            owner = np.where(every[other, np.arange(hi - lo)] <= least.max(), other, 0)
            owner[rows == centers[0]] = 0
            by_owner = np.argsort(owner, kind="stable")
            self.order[lo:hi] = rows[by_owner]
            ends = np.cumsum(np.bincount(owner, minlength=len(centers)))
            for i, c in enumerate(centers):
                a, b = int(ends[i - 1]) if i else 0, int(ends[i])
                if b > a:
                    self.children[me].append(add(lo + a, lo + b, c, every[i][by_owner[a:b]]))


class Side:
    """Ids and integer vectors in the order of a cover tree over them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int):
        floats = vectors.astype(np.float64)
        self.tree = CoverTree(floats, leaf)
        self.ids, self.vectors = ids[self.tree.order], vectors[self.tree.order]
        self.centers = floats[self.tree.center] if len(vectors) else floats
        self.norms = np.sqrt(np.einsum("ij,ij->i", self.centers, self.centers))
        self.radii = np.array(self.tree.radius)
        self.largest = float(np.abs(floats).max(initial=0))


def dual_search(queries: Side, rows: Side, k: int, counts: list | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query ids, row ids, scores) of each query's best k, as far as there are so many. ``counts``, if given, gets the
    number of pairs of vectors that were compared."""
    nq = len(queries.ids)
    if not nq or not len(rows.ids):
        return
    # Unfilled places hold the lowest score and the largest id.
    largest = queries.largest * rows.largest * queries.vectors.shape[1]
    if largest >= 2**63:
        raise OverflowError("components are too large for a score of 64 bits")
    number = np.float64 if largest < 2**53 else np.longdouble  # exact for integers up to that size
    q_vectors, r_vectors = queries.vectors.astype(number), rows.vectors.astype(number)
    score = np.full((nq, k), -np.inf, number)
    ident = np.full((nq, k), np.iinfo(np.int64).max)
    kth = score[:, -1].copy()
    bounds = queries.centers @ rows.centers.T + queries.norms[:, None] * rows.radii + queries.radii[:, None] * rows.norms + queries.radii[:, None] * rows.radii
    bounds += 1e-9 * (1 + np.abs(bounds))
    qt, rt = queries.tree, rows.tree

    q_floats = queries.vectors.astype(np.float64)
    q_norms = np.sqrt(np.einsum("ij,ij->i", q_floats, q_floats))

    def base(q: int, r: int) -> None:
        (a, b), (c, d) = qt.range[q], rt.range[r]
        # Of the node's queries, those that the row node may still have a result for.
        upper = q_floats[a:b] @ rows.centers[r] + q_norms[a:b] * rows.radii[r]
        live = a + np.flatnonzero(upper + 1e-9 * (1 + np.abs(upper)) >= kth[a:b])
        if not len(live):
            return
        if counts is not None:
            counts.append(len(live) * (d - c))
        s = q_vectors[live] @ r_vectors[c:d].T
        ids = rows.ids[c:d]
        s = np.where(queries.ids[live, None] == ids, -np.inf, s)
        better = (s >= kth[live, None]).any(axis=1)
        if not better.any():
            return
        live, s = live[better], s[better]
        if s.shape[1] > 4 * k:
            # Keep everything that ties with the kth best, so that ties are settled by id.
            cut = np.partition(s, -k, axis=1)[:, -k]
            wide = int((s >= cut[:, None]).sum(axis=1).max())
            if wide < s.shape[1]:
                best = np.argpartition(-s, wide - 1, axis=1)[:, :wide]
                s, ids = np.take_along_axis(s, best, 1), ids[best]
        ids = np.broadcast_to(ids, s.shape)
        both_s, both_i = np.concatenate([score[live], s], 1), np.concatenate([ident[live], ids], 1)
        top = np.lexsort((both_i, -both_s), axis=1)[:, :k]
        score[live], ident[live] = np.take_along_axis(both_s, top, 1), np.take_along_axis(both_i, top, 1)
        kth[live] = score[live, -1]

    stack = [(0, 0)]
    while stack:
        q, r = stack.pop()
        a, b = qt.range[q]
        if bounds[q, r] < kth[a:b].min():
            continue
        qs, rs = qt.children[q] or [q], rt.children[r] or [r]
        if qs == [q] and rs == [r]:
            base(q, r)
        else:
            pairs = [(x, y) for x in qs for y in rs]
            pairs.sort(key=lambda p: bounds[p])  # the most promising pair is taken first
            stack += pairs
    keep = score > -np.inf
    yield np.repeat(queries.ids, keep.sum(axis=1)), ident[keep], score[keep]


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    v = F.transform(F.col(vec_col), lambda x: F.floor(F.lit(scale) * x.cast("double")))
    usable = F.coalesce(F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
    return df.where(F.col(id_col).isNotNull() & usable).select(F.col(id_col).alias("id"), v.alias("v"))


def _arrays(batch: pa.RecordBatch) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and integer vectors by the vectors' length."""
    ids, lists = batch.column(0).to_numpy(), batch.column(1)
    sizes, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    return {int(n): (ids[own], flat[starts[own][:, None] + np.arange(n)]) for n in np.unique(sizes) for own in [np.flatnonzero(sizes == n)]}


def top_k(vectors: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, scale: int = SCALE, block_queries: int = 1 << 15, leaf: int = LEAF) -> DataFrame:
    """query_id, rank, vec_id, score. ``is_query`` is a condition on the column ``id``."""
    rows = integer_vectors(vectors, id_col, vec_col, scale)
    chosen = rows.where(is_query)
    n_blocks = max(1, -(-chosen.count() // block_queries))
    if n_blocks == 1:
        return _best(_search(rows, chosen.toArrow(), k, leaf)[0], k)
    parts = []
    for b in range(n_blocks):
        found, shared = _search(rows, chosen.where(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == b).toArrow(), k, leaf)
        parts.append(durable(_best(found, k)))
        shared.destroy()  # one block of queries is held at a time
    return reduce(DataFrame.unionByName, parts)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(rows: DataFrame, queries: pa.Table, k: int, leaf: int):
    """Each block's best k rows for each query, and the broadcast that has the queries."""
    by_size: dict[int, list] = {}
    for batch in queries.to_batches():
        for n, pair in _arrays(batch).items():
            by_size.setdefault(n, []).append(pair)
    sides = {n: Side(np.concatenate([i for i, _ in own]), np.concatenate([v for _, v in own]), max(1, leaf // 2)) for n, own in by_size.items()}
    shared = rows.sparkSession.sparkContext.broadcast(sides)

    def blocks(batches: Iterator[pa.RecordBatch]):
        waiting: dict[int, list] = {}
        for batch in batches:
            for n, pair in _arrays(batch).items() if batch.num_rows else ():
                waiting.setdefault(n, []).append(pair)
                if sum(len(i) for i, _ in waiting[n]) >= _BLOCK:
                    yield n, waiting.pop(n)
        yield from waiting.items()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, pairs in blocks(batches):
            if n not in shared.value:
                continue
            own = Side(np.concatenate([i for i, _ in pairs]), np.concatenate([v for _, v in pairs]), leaf)
            for q, r, s in dual_search(shared.value[n], own, k):
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(r, pa.int64()), pa.array(s.astype(np.int64))], names=["query_id", "vec_id", "score"])

    return in_arrow(rows.select(F.col("id").cast("long"), "v"), run, "query_id long, vec_id long, score long"), shared


def op8_topk(spark, sf_dir: str) -> DataFrame:
    from lessonweave.llm.common import table

    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("id") % 50 == 0)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
