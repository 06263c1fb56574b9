"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors of cosine t or more are at most eps = sqrt(2 - 2t) apart, and no farther in any orthogonal projection. Vectors are
projected on the leading principal dimensions, cut into cells of width eps and sorted by the cells in lexicographic order; the
sequence is cut into blocks of equal size. Intervals of blocks are joined recursively, sixteen to an interval: a pair of intervals
whose boxes are more than eps apart is skipped, any other is opened, down to pairs of blocks. Inside such a pair the
recursion goes on by halves to leaves, where distances of the centres of all dimensions answer for whole leaves that are
surely linked or surely apart, and products decide the rest. Equal vectors are one with a number of copies.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import components, saved
from .vptree import matrix, norms_of, pieces_of, products

COSINE = 0.95
LEADING = 8  # principal dimensions of the grid and the boxes
SAMPLE_VALUES = 1 << 19  # numbers in the vectors that the principal dimensions are fitted on, about; they decide speed only
BLOCK_ROWS = 4096  # at least; a larger table has larger blocks, and fewer copies of its vectors
BLOCK_MB = 32
FAN = 4  # bits of an interval's number that name its part
LEAF = 128
SLACK = 1e-9  # more than rounding can move a distance of unit vectors


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / norms_of(rows)[:, None]


def principal(rows: np.ndarray, dims: int = LEADING) -> np.ndarray:
    """Orthonormal columns along which the rows spread most."""
    _, _, axes = np.linalg.svd(rows - rows.mean(axis=0), full_matrices=False)
    return np.ascontiguousarray(axes[:dims].T)


def labels_of(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest of the nodes 0 .. n - 1 that each reaches over the edges."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        for at in (i, j, before[i], before[j]):
            np.minimum.at(label, at, low)
        label = label[label]
        if (label == before).all():
            return label


class Side:
    """Vectors of a block in grid order, with their projections and numbers of copies."""

    def __init__(self, table, basis: dict[int, np.ndarray]):
        self.vectors = matrix(table["v"])
        order = np.argsort(table["place"].to_numpy(), kind="stable")
        self.vectors = self.vectors[order]
        self.nodes, self.copies = (table[c].to_numpy()[order] for c in ("place", "copies"))
        self.norms = norms_of(self.vectors)
        self.units = self.vectors / self.norms[:, None]
        self.projected = self.units @ axes_of(basis, self.vectors.shape[1])
        self.links = np.zeros(len(self.nodes), np.int64)
        self.boxes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.balls: dict[tuple[int, int], tuple[np.ndarray, float]] = {}

    def box(self, low: int, high: int):
        if (low, high) not in self.boxes:
            own = self.projected[low:high]
            self.boxes[low, high] = own.min(axis=0), own.max(axis=0)
        return self.boxes[low, high]

    def ball(self, low: int, high: int):
        if (low, high) not in self.balls:
            own = self.units[low:high]
            centre = own.mean(axis=0)
            self.balls[low, high] = centre, float(np.sqrt(((own - centre) ** 2).sum(axis=1).max()))
        return self.balls[low, high]


def axes_of(basis: dict[int, np.ndarray], dim: int) -> np.ndarray:
    """The fitted directions of vectors of ``dim`` components, or the first coordinates where none were in the sample."""
    return basis[dim] if dim in basis else np.eye(dim)[:, :LEADING]


def joined(a: Side, b: Side, cosine: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Adds the links of each vector of two blocks (one, if a is b); edges that connect what they connect, as rows of a and rows of b."""
    eps, edges = max(0.0, 2 - 2 * cosine) ** 0.5, []

    def leaf(s: int, e: int, t: int, f: int) -> None:
        (p, r), (q, z) = a.ball(s, e), b.ball(t, f)
        between = float(np.sqrt(((p - q) ** 2).sum()))
        if between - r - z > eps + SLACK:
            return
        same = a is b and s == t
        if between + r + z < eps - SLACK:
            a.links[s:e] += b.copies[t:f].sum()
            if same:
                a.links[s:e] -= a.copies[s:e]
            else:
                b.links[t:f] += a.copies[s:e].sum()
            edges.append((np.arange(s, e), np.full(e - s, t)))
            edges.append((np.full(f - t, s), np.arange(t, f)))
            return
        product = a.units[s:e] @ b.units[t:f].T
        near = product >= cosine
        i, j = np.nonzero(np.abs(product - cosine) < SLACK)
        near[i, j] = products(a.vectors[s:e], i, b.vectors[t:f], j) / (a.norms[s + i] * b.norms[t + j]) >= cosine
        if same:
            np.fill_diagonal(near, False)
        a.links[s:e] += near @ b.copies[t:f]
        if not same:
            b.links[t:f] += a.copies[s:e] @ near
        i, j = np.nonzero(near)
        if len(i) > 4 * LEAF:  # a tree of them is enough
            label = labels_of(e - s + f - t, i, j + e - s)
            member, root = np.arange(e - s, len(label)), label[e - s :]
            linked = root != member
            i, j = root[linked], member[linked] - (e - s)  # roots of linked rows of b are rows of a, which come first
            own = np.flatnonzero(label[: e - s] != np.arange(e - s))
            if len(own):  # rows of a under another row of a: over a row of b that both reach
                via = np.full(len(label), -1)
                via[root[linked][::-1]] = (member[linked] - (e - s))[::-1]
                i, j = np.append(i, own), np.append(j, via[label[own]])
        edges.append((s + i, t + j))

    def visit(s: int, e: int, t: int, f: int) -> None:
        (low, high), (under, over) = a.box(s, e), b.box(t, f)
        if (np.maximum(0, np.maximum(low - over, under - high)) ** 2).sum() > (eps + SLACK) ** 2:
            return
        if e - s <= LEAF and f - t <= LEAF:
            leaf(s, e, t, f)
            return
        halves = lambda x, y: [(x, y)] if y - x <= LEAF else [(x, (x + y) // 2), ((x + y) // 2, y)]
        for x, y in halves(s, e):
            for v, w in halves(t, f):
                if a is not b or x <= v:
                    visit(x, y, v, w)

    visit(0, len(a.nodes), 0, len(b.nodes))
    return edges


def near_vectors(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Links are pairs of rows whose vectors have a cosine of at least ``cosine`` (above zero) in double precision; ``n_links`` counts the
    other rows linked directly, ``component_id`` is the smallest id reachable over links, its own included, and ``kept`` tells whether that is the
    row's own. Equal vectors and repeated rows link like any others. Vectors that are null, empty, zero or hold null, NaN or
    infinite components link with nothing and are kept; vectors of different lengths never link. Rows with a null id take part and get
    the smallest id of their component, null and kept if it has none. An empty table gives no rows; other columns are not read.
    """
    import pyarrow as pa

    v = F.col(vector_col)
    good = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    kind = vectors.schema[vector_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(good, v if kind == "array<float>" else v.cast("array<double>")).alias("v"))
    classes = rows.where("v is not null").groupBy("v").agg(F.min("id").alias("low"), F.count("*").alias("copies"))
    classes = saved(classes.withColumn("dim", F.size("v")))
    n, values = classes.agg(F.count("*"), F.coalesce(F.sum("dim"), F.lit(0))).first()

    drawn = F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < int(min(1.0, SAMPLE_VALUES / max(1, values)) * (1 << 20))
    basis = {}
    for row in classes.where(drawn).groupBy("dim").agg(F.collect_list(F.col("v").cast("array<double>")).alias("vs")).collect() if n else ():
        basis[row["dim"]] = principal(unit(np.array(row["vs"])))
    eps = max(0.0, 2 - 2 * cosine) ** 0.5

    def projected(batches):
        for batch in batches:
            own, dims = batch.column(0), batch.column(1).to_numpy()
            cells, place = np.zeros((len(dims), LEADING), np.int64), np.zeros((len(dims), LEADING))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                p = unit(matrix(pa.chunked_array([own.take(pa.array(at))]))) @ axes_of(basis, int(dim))
                place[at, : p.shape[1]] = p
                cells[at, : p.shape[1]] = np.floor(p / max(eps, SLACK))
            ends = pa.array(np.arange(len(dims) + 1, dtype=np.int32) * LEADING)
            lists = [pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in (cells, place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=["v", "dim", "low", "copies", "cells", "p"])

    kind = classes.schema["v"].dataType.simpleString()
    pieces = pieces_of(n, BLOCK_ROWS, BLOCK_MB, 8 * values / max(1, n))
    size = -(-max(1, n) // pieces)
    order = ["dim", "cells", "p", "low"]
    placed = classes.select("v", "dim", "low", "copies").mapInArrow(projected, f"v {kind}, dim int, low long, copies long, cells array<long>, p array<double>")
    placed = placed.repartitionByRange(pieces, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = saved(placed.select("v", "dim", "low", "copies", "p", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("seq")))
    # a place in the whole sequence: one row per range is summed up in order
    parts = placed.groupBy("part").agg(F.count("*").alias("rows")).withColumn("first", F.sum("rows").over(Window.orderBy("part")) - F.col("rows"))
    placed = placed.join(parts.select("part", "first"), "part").withColumn("place", F.col("first") + F.col("seq"))
    placed = saved(placed.select("v", "dim", "low", "copies", "p", "place", F.floor(F.col("place") / size).cast("long").alias("block")))

    edge = [(f(F.col("p")[k]).alias(f"{name}{k}")) for k in range(LEADING) for f, name in ((F.min, "lo"), (F.max, "hi"))]
    boxes = saved(placed.groupBy("dim", "block").agg(*edge))
    levels = 0
    while pieces >> (FAN * levels):
        levels += 1
    pairs = boxes.select("dim", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")).distinct()
    for level in range(levels - 1, -1, -1):  # from intervals of 16 ** level blocks down to blocks
        number = F.shiftright("block", FAN * level)
        own = boxes.groupBy("dim", number.alias("x")).agg(*[f(f"{s}{k}").alias(f"{s}{k}") for k in range(LEADING) for f, s in ((F.min, "lo"), (F.max, "hi"))])
        left = own.withColumn("a", F.shiftright("x", FAN))
        right = own.select("dim", F.col("x").alias("y"), F.shiftright("x", FAN).alias("b"), *[F.col(f"{s}{k}").alias(f"{s}_{k}") for k in range(LEADING) for s in ("lo", "hi")])
        gap = sum((F.pow(F.greatest(F.lit(0.0), F.col(f"lo{k}") - F.col(f"hi_{k}"), F.col(f"lo_{k}") - F.col(f"hi{k}")), 2) for k in range(LEADING)), F.lit(0.0))
        pairs = pairs.join(left, ["dim", "a"]).join(right, ["dim", "b"]).where((F.col("x") <= F.col("y")) & (gap <= (eps + SLACK) ** 2))
        pairs = saved(pairs.select("dim", F.col("x").alias("a"), F.col("y").alias("b")))

    def work(mine, others):
        if not mine.num_rows:
            return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        a = Side(mine, basis)
        b = Side(others, basis) if others.num_rows else a
        edges = joined(a, b, cosine)
        shift = 0 if b is a else len(a.nodes)
        i, j = (np.concatenate([np.zeros(0, np.int64), *[e[k] for e in edges]]) for k in (0, 1))
        nodes, links = (a.nodes, a.links) if b is a else (np.append(a.nodes, b.nodes), np.append(a.links, b.links))
        root = nodes[labels_of(len(nodes), i, j + shift)]
        found = links > 0
        return pa.table({"node": nodes[found], "links": links[found], "root": root[found]})

    body = placed.select("v", "dim", "block", "place", "copies")
    left = body.join(pairs.withColumnRenamed("a", "block"), ["dim", "block"]).select("v", "place", "copies", "dim", F.col("block").alias("a"), "b")
    right = body.join(pairs.where("a < b").withColumnRenamed("b", "block"), ["dim", "block"]).select(*[F.col(c).alias(c) for c in ("v", "place", "copies", "dim", "a")], F.col("block").alias("b"))
    key = ["dim", "a", "b"]
    found = saved(left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(work, "node long, links long, root long"))

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = placed.select("v", "low", "copies", F.col("place").alias("node")).join(links, "node", "left").join(components(found, "node", "root").withColumnRenamed("root", "to"), "node", "left")
    named = saved(named.select("v", "low", F.coalesce("to", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    smallest = saved(named.groupBy("root").agg(F.min("low").alias("component_id")))
    named = saved(named.join(smallest, "root").select("v", "n_links", "component_id"))
    linked = rows.where("v is not null").join(named, "v").select("id", "n_links", "component_id")
    out = linked.unionByName(rows.where("v is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


ORACLE = r"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS row, vec_id, CAST(embedding AS DOUBLE[]) AS v, embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS good FROM embeddings
), u AS MATERIALIZED (
  SELECT row, v, len(v) AS dim, sqrt(list_reduce(list_transform(v, lambda x: x * x), lambda x, y: x + y)) AS norm FROM v WHERE good
), l AS MATERIALIZED (
  SELECT a.row AS a, b.row AS b FROM u a JOIN u b ON a.dim = b.dim AND a.row <> b.row AND list_reduce(list_transform(range(1, a.dim + 1), lambda i: a.v[i] * b.v[i]), lambda x, y: x + y) / (a.norm * b.norm) >= 0.95
), reach AS (
  SELECT row AS a, row AS b FROM v UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b
), c AS (
  SELECT reach.a AS row, min(vec_id) AS component_id FROM reach JOIN v ON v.row = reach.b GROUP BY reach.a
), n AS (
  SELECT a AS row, count(*) AS n_links FROM l GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN c USING (row) LEFT JOIN n USING (row)
"""
