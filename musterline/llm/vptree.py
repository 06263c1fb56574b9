"""Nearest neighbours by inner product with vantage-point trees per shard.

Inner product becomes a metric by one more coordinate: a vector x of a shard whose largest norm is M gets
sqrt(M^2 - |x|^2), a query is scaled to norm M and gets 0, and then a smaller distance is a larger product. Each
shard's tree splits at the median distance to a vantage point; a subtree is skipped when the triangle inequality, with the
current k-th distance multiplied by ``factor``, excludes it. Factor one is exact search, smaller factors prune more.
Equal vectors of a shard are one leaf entry with the ids it may have to return. A shard has one tree per binary order of
norms, so that M is near the norms of its points. The tree first finds enough vectors to bound the k-th product from below,
then every vector whose distance is within that bound plus rounding; ranks come from exact products of all of them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 8192  # at least; a larger table has larger shards, and fewer copies of its queries
SHARD_MB = 64
BLOCK_ROWS = 2048  # at least; more queries make larger blocks, and fewer copies of the vectors
BLOCK_MB = 16
LEAF = 512
FACTOR = 1.0
PAIRS = 1 << 20  # most pairs of a query and a point held at once


class Tree:
    """A vantage-point tree over the rows of an array."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.leaf = points, leaf
        self.squares = np.einsum("ij,ij->i", points, points)
        size = 2.0**-52 * 16 * (points.shape[1] + 4) * float(self.squares.max(initial=0))
        self.rounding = size  # more than a squared distance can be off
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        some = rows[:: max(1, len(rows) // 8)][:8]
        spread = [np.var(self._between(self.points[v : v + 1], rows[:: max(1, len(rows) // 256)])) for v in some]
        vantage = int(some[int(np.argmax(spread))])
        distance = self._between(self.points[vantage : vantage + 1], rows)[0]
        middle = float(np.median(distance))
        near = distance <= middle
        if near.all():
            near = distance < middle
            middle = float(distance[near].max()) if near.any() else middle
        if not near.any():
            return rows
        return vantage, middle, self._build(rows[near]), self._build(rows[~near])

    def _between(self, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
        squares = np.einsum("ij,ij->i", queries, queries)[:, None] + self.squares[rows] - 2 * queries @ self.points[rows].T
        return np.sqrt(np.maximum(squares, 0))

    def search(self, queries: np.ndarray, k: int, factor: float = FACTOR) -> tuple[np.ndarray, np.ndarray]:
        """Distances and rows (-1: none) of up to k nearest points of each query, in no order."""
        best, found = np.full((len(queries), k), np.inf), np.full((len(queries), k), -1)
        slack = 1e-9 * (1 + float(self.squares.max(initial=0)) ** 0.5)

        def visit(node, at: np.ndarray) -> None:
            if not len(at):
                return
            if isinstance(node, np.ndarray):
                distance = np.concatenate([best[at], self._between(queries[at], node)], axis=1)
                rows = np.concatenate([found[at], np.broadcast_to(node, (len(at), len(node)))], axis=1)
                keep = np.argpartition(distance, k - 1, axis=1)[:, :k]
                best[at], found[at] = np.take_along_axis(distance, keep, 1), np.take_along_axis(rows, keep, 1)
                return
            vantage, middle, inner, outer = node
            distance = self._between(queries[at], np.array([vantage]))[:, 0]
            inside = distance <= middle
            visit(inner, at[inside])
            visit(outer, at[~inside])
            reach = best[at].max(axis=1) * factor + slack
            visit(outer, at[inside & (middle - distance <= reach)])
            visit(inner, at[~inside & (distance - middle <= reach)])

        visit(self.root, np.arange(len(queries)))
        return best, found

    def within(self, queries: np.ndarray, squared: np.ndarray, factor: float = FACTOR) -> tuple[np.ndarray, np.ndarray]:
        """Queries and rows of all points whose squared distance is at most ``squared`` of the query, or may be but for rounding."""
        limit = squared + self.rounding
        reach = np.sqrt(np.maximum(limit, 0)) * factor + 3 * np.sqrt(self.rounding)
        asked, rows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

        def visit(node, at: np.ndarray) -> None:
            if not len(at):
                return
            if isinstance(node, np.ndarray):
                squares = self._between(queries[at], node) ** 2
                i, j = np.nonzero(squares <= (limit[at] + self.rounding)[:, None])
                asked.append(at[i])
                rows.append(node[j])
                return
            vantage, middle, inner, outer = node
            distance = self._between(queries[at], np.array([vantage]))[:, 0]
            visit(inner, at[distance - middle <= reach[at]])
            visit(outer, at[middle - distance <= reach[at]])

        visit(self.root, np.arange(len(queries)))
        return np.concatenate(asked), np.concatenate(rows)


def matrix(column) -> np.ndarray:
    """A list column without nulls, of one length, as doubles."""
    column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def products(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of rows i of a and rows j of b, added in order, so that equal vectors have equal products."""
    total = np.zeros(len(i))
    for x in range(a.shape[1]):
        total += a[i, x] * b[j, x]
    return total


def norms_of(rows: np.ndarray) -> np.ndarray:
    """Norms, without overflow of squares."""
    top = np.abs(rows).max(axis=1)
    return top * np.sqrt(((rows / top[:, None]) ** 2).sum(axis=1))


def search_shard(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float):
    """(query_id, vec_id, score) of each query's k nearest in one shard, its own id left out."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
    _, first, of = np.unique(vectors.view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel(), return_index=True, return_inverse=True)
    by, ids_of = np.unique(np.column_stack([of, ids]), axis=0).T  # distinct ids of each class, ascending
    start = np.searchsorted(by, np.arange(len(first) + 1))
    points = vectors[first]
    norms, lengths = norms_of(points), norms_of(queries)
    trees = []  # the power of two that scales a tree's points, its points and the tree
    order = np.frexp(norms)[1]
    for power in np.unique(order):
        rows = np.flatnonzero(order == power)
        own, norm = np.ldexp(points[rows], -power), np.ldexp(norms[rows], -power)
        top = norm.max()
        trees.append((power, rows, top, Tree(np.column_stack([own, np.sqrt(np.maximum(top**2 - norm**2, 0))]))))
    unit = np.column_stack([queries / lengths[:, None], np.zeros(len(queries))])
    want = (k + 1) * int(np.unique(ids_of, return_counts=True)[1].max())  # so many vectors hold k other ids
    parts = []
    step = max(1, PAIRS // len(points))
    for low in range(0, len(queries), step):
        at = np.arange(low, min(low + step, len(queries)))
        seen = np.full((len(at), want), -np.inf)
        for _, rows, top, tree in trees:
            _, found = tree.search(unit[at] * top, min(want, len(rows)), factor)
            q, c = np.nonzero(found >= 0)
            score = np.full(found.shape, -np.inf)
            score[q, c] = products(queries, at[q], points, rows[found[q, c]])
            seen = -np.partition(-np.concatenate([seen, score], axis=1), want - 1, axis=1)[:, :want]
        least = seen.min(axis=1)  # no smaller product can be among the k
        for power, rows, top, tree in trees:
            with np.errstate(invalid="ignore"):
                squared = 2 * top * (top - np.ldexp(least / lengths[at], -power))
            q, c = tree.within(unit[at] * top, np.where(np.isfinite(squared), squared, np.inf), factor)
            c = rows[c]
            score = products(queries, at[q], points, c)
            fits = score >= least[q]
            parts.append(best_of(at[q[fits]], c[fits], score[fits], ids_of, start, query_ids, k))
    q, found, score = (np.concatenate([p[i] for p in parts]) for i in range(3))
    q, found, score = ranked(q, found, score, k)
    return query_ids[q], found, score


def best_of(q, c, score, ids, start, query_ids, k: int):
    """The k best of (query, id, score) among the classes ``c`` of equal vectors, the query's own id left out."""
    size = np.minimum(start[c + 1] - start[c], k + 1)
    out = [np.zeros(0, np.int64)], [np.zeros(0, ids.dtype)], [np.zeros(0)]
    ends = np.cumsum(size)
    low = 0
    while low < len(q):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + 4 * PAIRS, side="right")))
        n = size[low:high]
        each = low + np.repeat(np.arange(high - low), n)
        place = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
        found = ids[start[c[each]] + place]
        other = found != query_ids[q[each]]
        for x, y in zip(out, ranked(q[each][other], found[other], score[each][other], k)):
            x.append(y)
        low = high
    return tuple(np.concatenate(x) for x in out)


def ranked(q, found, score, k: int):
    """The k rows of each query by score, then id; an id that stands twice with the same score counts once."""
    order = np.lexsort((found, -score, q))
    q, found, score = q[order], found[order], score[order]
    new = np.ones(len(q), bool)
    new[1:] = (q[1:] != q[:-1]) | (found[1:] != found[:-1]) | (score[1:] != score[:-1])
    q, found, score = q[new], found[new], score[new]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], found[keep], score[keep]


def pieces_of(n: int, least: int, most_mb: float, width: float) -> int:
    """Pieces of n vectors of ``width`` bytes: of ``least`` rows each up to 64 pieces, then 64 until a piece has ``most_mb``, then more."""
    return max(1, min(n // least + 1, 64), int(n * width / (most_mb * 1e6)) + 1)


def nearest(vectors: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", query_mod: int = 20, factor: float = FACTOR) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest inner product for each query.

    Queries are the rows whose id is divisible by ``query_mod``, candidates all rows but those with the query's own id,
    ties go to the smaller id. Vectors that are null, empty, zero or hold null, NaN or infinite components take no part,
    nor do rows with a null id; vectors of different lengths never meet. Equal rows count once; where one id has several
    vectors its ranks go over all of them. Fewer than ``k`` candidates give fewer rows; an empty table gives none.
    """
    import pyarrow as pa

    v = F.col(vector_col)
    good = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col(id_col).isNotNull() & good).select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"), F.size(v).alias("dim"))
    queries = rows.where(F.col("id") % query_mod == 0)
    n, n_queries, values = rows.agg(F.count("*"), F.coalesce(F.sum((F.col("id") % query_mod == 0).cast("long")), F.lit(0)), F.coalesce(F.sum("dim"), F.lit(0))).first()
    width = max(1.0, 8 * values / max(1, n))  # bytes of a vector
    shards = pieces_of(n, SHARD_ROWS, SHARD_MB, width)
    blocks = pieces_of(n_queries, BLOCK_ROWS, BLOCK_MB, width)

    def every(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    shard, block = (F.pmod(F.xxhash64("id", F.lit(c)), F.lit(n)).cast("int") for c, n in (("s", shards), ("b", blocks)))
    left = rows.withColumn("shard", shard).withColumn("block", every(blocks))
    right = queries.withColumn("block", block).withColumn("shard", every(shards))

    def search(mine, asked):
        if mine.num_rows and asked.num_rows:
            q, found, score = search_shard(mine["id"].to_numpy(), matrix(mine["v"]), asked["id"].to_numpy(), matrix(asked["v"]), k, factor)
        else:
            q, found, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return pa.table({"query_id": q, "vec_id": found, "score": score})

    key = ["shard", "block", "dim"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = r"""
WITH v AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]), lambda x, y: x + y) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(row_number() OVER w AS INT) AS rank, vec_id, score FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 20
"""
