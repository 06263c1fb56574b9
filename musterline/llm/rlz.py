"""Substring dedup by relative Lempel-Ziv parsing of every document against all earlier text.

The reference is the whole corpus in (id, position) order, cut into blocks at content-defined anchors: in each
run of ``window`` words the smallest hash of ``GRAM`` consecutive words is the anchor, and the windows that share
an anchor form one block. Equal text is therefore cut alike wherever it stands, so a document's greedy factors
are runs of blocks that the index holds from an earlier place. The index answers for most blocks outright:

* another place holds the whole block earlier: all its windows repeat, the factor goes on;
* no earlier place has its anchor: none of its windows repeats;
* otherwise a factor starts or ends inside the block, and its windows are checked one by one.

Words covered by a repeated window are the duplicate spans. Repeats inside a bucket of documents are resolved
there, so that a passage found everywhere sends one row per bucket and not one per copy. An anchor that has several
surroundings in one bucket is known there to need its windows checked: the bucket sends two of its blocks for the others to
know, however many it has. Blocks are compared by two 64-bit hashes together.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import bucketed, pieces, release, rolled, signed, spans, text_buffers, word_hashes

WINDOW = 20
GRAM = 6
BUCKET_MB = 3.0
PART = "bucket int, id long, pos int, g long, e long, kind byte"
WHOLE, EDGE, SINGLE = 1, 2, 3  # block repeats as a whole; block needs its windows checked; window repeats


def leftmost_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Position of the first smallest value of every ``width`` consecutive ones."""
    at, size = np.arange(len(x)), 1
    while size < width:
        step = min(size, width - size)
        left, right = at[:-step], at[step:]
        at = np.where(x[right] < x[left], right, left)
        size += step
    return at


class Bucket:
    """The words and blocks of one bucket's documents, in id order."""

    def __init__(self, table, window: int, gram: int):
        ids = table.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
        self.order = np.argsort(ids, kind="stable")
        table = table.take(self.order)
        self.table, self.ids, self.window = table, ids[self.order], window
        self.raw, self.offsets = text_buffers(table.column("text"))
        parts = []
        for low, high in pieces(self.offsets):
            base = self.offsets[low]
            raw, local = self.raw[base : self.offsets[high]], self.offsets[low : high + 1] - base
            starts, ends, rows = spans(raw, local)
            parts.append((starts + base, ends + base, rows + low, word_hashes(raw, starts, ends) if len(starts) else np.zeros(0, np.uint64)))
        self.starts, self.ends, self.rows, self.hashes = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(4))
        self.first = np.searchsorted(self.rows, np.arange(len(self.ids) + 1))  # first word of each row
        self._blocks(gram)

    def _blocks(self, gram: int) -> None:
        n, window, width = len(self.rows), self.window, self.window - gram + 1
        if n < window:
            self.lo = self.hi = self.anchor = np.zeros(0, np.int64)
            self.g = self.e = np.zeros(0, np.uint64)
            return
        grams = rolled(self.hashes, np.arange(n - gram + 1), np.arange(gram, n + 1))
        at = leftmost_minimum(grams, width)
        inside = np.flatnonzero(self.rows[: n - window + 1] == self.rows[window - 1 :])
        at = at[inside]
        edge = np.flatnonzero(np.diff(at, prepend=-1))
        self.lo, self.hi, self.anchor = inside[edge], inside[np.append(edge[1:] - 1, len(at) - 1)] if len(at) else inside, at[edge]
        self.g, self.e = grams[self.anchor], rolled(self.hashes, self.lo, self.hi + window)

    def several(self) -> np.ndarray:
        """Which blocks have an anchor that stands in other blocks of this bucket too."""
        order = np.lexsort((self.e, self.g))
        g, e = self.g[order], self.e[order]
        start = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.zeros(0, np.int64)
        size = np.diff(np.append(start, len(g)))
        out = np.zeros(len(g), bool)
        out[order] = np.repeat(e[start] != e[start + size - 1], size)
        return out

    def outermost(self) -> np.ndarray:
        """Which blocks have the least or the greatest hash of their anchor's blocks."""
        order = np.lexsort((self.e, self.g))
        g, e = self.g[order], self.e[order]
        start = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.zeros(0, np.int64)
        size = np.diff(np.append(start, len(g)))
        out = np.zeros(len(g), bool)
        out[order] = (e == np.repeat(e[start], size)) | (e == np.repeat(e[start + size - 1], size))
        return out

    def places(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document id and position inside the document of words."""
        rows = self.rows[words]
        return self.ids[rows], words - self.first[rows]

    def repeats(self, one: np.ndarray, two: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of keys (one, two) at ascending words: which stand at a later place than an equal key, and which come first."""
        order = np.lexsort((two, one))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
        head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))] if len(order) else order
        ids, pos = self.places(words)
        again = np.zeros(len(order), bool)
        again[order] = (ids[order] != ids[head]) | (pos[order] != pos[head])
        first = np.zeros(len(order), bool)
        first[order[new]] = True
        return again, first

    def windows_of(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, hash and anchor hash of each window of the chosen blocks."""
        size = self.hi[chosen] - self.lo[chosen] + 1
        begin = np.repeat(self.lo[chosen] - np.cumsum(size) + size, size)
        at = begin + np.arange(len(begin))
        return at, rolled(self.hashes, at, at + self.window) if len(at) else np.zeros(0, np.uint64), np.repeat(self.g[chosen], size)

    def told(self, said, kind: int) -> np.ndarray:
        """Which blocks the rows of ``kind`` name."""
        import pandas as pd

        ids, pos = self.places(self.anchor)
        if not len(ids):
            return np.zeros(0, bool)
        mine = pd.MultiIndex.from_arrays([ids, pos, signed(self.e)])
        rows = said[said["kind"] == kind]
        return mine.isin(pd.MultiIndex.from_arrays([rows["id"], rows["pos"], rows["e"]]))


def _rows(bucket: int, ids, pos, g, e, kind: int):
    import pyarrow as pa

    n = len(ids)
    return pa.table({
        "bucket": pa.array(np.full(n, bucket, np.int32)), "id": pa.array(ids), "pos": pa.array(pos.astype(np.int32)),
        "g": pa.array(signed(g)), "e": pa.array(signed(e)), "kind": pa.array(np.full(n, kind, np.int8)),
    })


def _kept(bucket: Bucket, keep: np.ndarray, joined: bool):
    """The text of each row's kept words: joined by one space, or each with the white space that followed it."""
    import pyarrow as pa

    starts, ends, rows = bucket.starts, bucket.ends, bucket.rows
    n = len(bucket.ids)
    if not joined and len(starts):
        last = np.append(rows[1:] != rows[:-1], True)
        ends = np.where(last, bucket.offsets[rows + 1], np.append(starts[1:], 0))
        starts = np.where(np.append(True, rows[1:] != rows[:-1]), bucket.offsets[rows], starts)
    starts, ends, rows = starts[keep], ends[keep], rows[keep]
    length = ends - starts
    gap = np.append(rows[1:] == rows[:-1], False).astype(np.int64) if joined and len(rows) else np.zeros(len(rows), np.int64)
    place = np.cumsum(length + gap) - length - gap
    out = np.full(int((length + gap).sum()), 32, np.uint8)
    for low, high in pieces(np.append(place, len(out)), 1 << 22):
        size = length[low:high]
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(place[low:high], size) + step] = bucket.raw[np.repeat(starts[low:high], size) + step]
    ends_at = np.zeros(n + 1, np.int64)
    ends_at[1:] = np.cumsum(np.bincount(rows, weights=length + gap, minlength=n).astype(np.int64))
    return pa.StringArray.from_buffers(n, pa.py_buffer(ends_at.astype(np.int32).tobytes()), pa.py_buffer(out.tobytes()))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, window: int = WINDOW, joined: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, spans, kept, and struct ``row`` of the columns in ``carry``.

    A word goes if some run of ``window`` words that covers it also starts earlier: in a smaller id, or earlier in
    the same document. ``spans`` are the removed word ranges [start, end); ``kept`` is the text of the other words,
    joined by one space or, by default, with the white space that followed each, so that a text which loses nothing and
    has words is kept as it was. Null text counts as empty and gives an empty ``kept``. Texts shorter than a window lose nothing. Rows with a null id lose nothing and count
    for no other row; equal rows (same id and text) count as one document and get equal results. An empty table
    gives no rows. Columns of ``docs`` may have any names.
    """
    import pyarrow as pa

    gram = min(GRAM, window)
    source = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in carry or [id_col]]).alias("row"),
    )
    source = bucketed(source, "id", "text", BUCKET_MB)
    known = source.where(F.col("id").isNotNull())

    def blocks(table):
        release()
        b = Bucket(table, window, gram)
        _, first = b.repeats(b.e, b.g, b.anchor)
        first &= b.outermost()
        ids, pos = b.places(b.anchor[first])
        return _rows(table.column("bucket")[0].as_py(), ids, pos, b.g[first], b.e[first], 0)

    def edges(table, said):
        if not table.num_rows:
            return _rows(0, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), 0)
        release()
        b, said = Bucket(table, window, gram), said.to_pandas()
        again, _ = b.repeats(b.e, b.g, b.anchor)
        at, h, g = b.windows_of(np.flatnonzero((b.told(said, EDGE) | b.several()) & ~again & ~b.told(said, WHOLE)))
        _, first = b.repeats(h, g, at)
        ids, pos = b.places(at[first])
        return _rows(table.column("bucket")[0].as_py(), ids, pos, g[first], h[first], 0)

    def parse(table, said):
        if not table.num_rows:
            return nothing(table)
        release()
        b, said = Bucket(table, window, gram), said.to_pandas()
        again, _ = b.repeats(b.e, b.g, b.anchor)
        covered = again | b.told(said, WHOLE)
        whole = np.flatnonzero(covered)
        hit = np.zeros(len(b.rows) + 1, np.int64)
        np.add.at(hit, b.lo[whole], 1)
        np.add.at(hit, b.hi[whole] + window, -1)
        at, h, g = b.windows_of(np.flatnonzero((b.told(said, EDGE) | b.several()) & ~covered))
        if len(at):
            import pandas as pd

            later, _ = b.repeats(h, g, at)
            ids, pos = b.places(at)
            single = said[said["kind"] == SINGLE]
            later |= pd.MultiIndex.from_arrays([ids, pos, signed(h)]).isin(pd.MultiIndex.from_arrays([single["id"], single["pos"], single["e"]]))
            np.add.at(hit, at[later], 1)
            np.add.at(hit, at[later] + window, -1)
        keep = np.cumsum(hit)[:-1] == 0
        n = len(b.ids)
        start = np.flatnonzero(~keep & np.append(True, keep[:-1] | (b.rows[1:] != b.rows[:-1]))) if len(keep) else np.zeros(0, np.int64)
        stop = np.flatnonzero(~keep & np.append(keep[1:] | (b.rows[1:] != b.rows[:-1]), True)) + 1 if len(keep) else start
        offsets = np.searchsorted(b.rows[start], np.arange(n + 1)).astype(np.int32)
        begin = start - b.first[b.rows[start]]
        pair = pa.StructArray.from_arrays([pa.array(begin.astype(np.int32)), pa.array((begin + stop - start).astype(np.int32))], ["start", "end"])
        return pa.table({
            "id": pa.array(b.ids), "n_words": pa.array(np.bincount(b.rows, minlength=n).astype(np.int64)),
            "n_removed": pa.array(np.bincount(b.rows[~keep], minlength=n).astype(np.int64)),
            "spans": pa.ListArray.from_arrays(pa.array(offsets), pair), "kept": _kept(b, keep, joined), "row": b.table.column("row"),
        })

    row_type = source.schema["row"].dataType.simpleString()
    shape = f"id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept string, row {row_type}"

    def nothing(table):
        return pa.table({
            "id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()),
            "spans": pa.array([], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), "kept": pa.array([], pa.string()),
            "row": table.column("row"),
        })

    place = F.struct("id", "pos")
    index = known.groupBy("bucket").applyInArrow(blocks, PART).repartition("g").sortWithinPartitions("g", "e")
    same, anchor = Window.partitionBy("g", "e"), Window.partitionBy("g")
    judged = (
        index.withColumn("head", F.min(place).over(same))
        .withColumn("low", F.min("e").over(anchor)).withColumn("high", F.max("e").over(anchor))
        .withColumn("kind", F.when(place != F.col("head"), WHOLE).when(F.col("low") != F.col("high"), EDGE).otherwise(0).cast("byte"))
        .where("kind > 0").select("bucket", "id", "pos", "g", "e", "kind")
    )
    checked = known.groupBy("bucket").cogroup(judged.groupBy("bucket")).applyInArrow(edges, PART)
    single = (
        checked.withColumn("head", F.min(place).over(same)).where(place != F.col("head"))
        .select("bucket", "id", "pos", "g", "e", F.lit(SINGLE).cast("byte").alias("kind"))
    )
    found = known.groupBy("bucket").cogroup(judged.union(single).groupBy("bucket")).applyInArrow(parse, shape)
    out = found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "spans", "kept", "row")
    bare = source.where(F.col("id").isNull())
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    text = F.concat_ws(" ", words) if joined else F.col("text")
    return out.unionByName(bare.select(
        F.col("id").alias("doc_id"), F.size(words).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
        F.array().cast("array<struct<start:int,end:int>>").alias("spans"), text.alias("kept"), "row",
    ))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), g AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 19], ' ')) AS key FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w WHERE len(words) >= 20)
), f AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY key ORDER BY doc_id, i) > 1 AS again FROM g
), c AS (
  SELECT DISTINCT doc_id, j FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM f WHERE again)
), r AS (
  SELECT doc_id, list(j) AS gone FROM c GROUP BY doc_id
), k AS (
  SELECT w.doc_id, words, coalesce(gone, []) AS gone FROM w LEFT JOIN r ON r.doc_id = w.doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed, sha256(CASE WHEN len(gone) = 0 THEN array_to_string(words, ' ') ELSE
  coalesce(array_to_string(list_filter(list_transform(words, lambda x, i: CASE WHEN list_contains(gone, i) THEN NULL ELSE x END), lambda x: x IS NOT NULL), ' '), '') END) AS kept_sha256 FROM k
"""
