"""Periodic runs of words: stretches that repeat one phrase at least four times.

Whether words q apart agree is counted for every lag q of a text at once, exactly: words that are frequent in the text by an
FFT autocorrelation of their positions, rare ones by the differences of their pairs of positions. A run of period q holds at
least max(6, 4q) - q matches in a row, so only lags with that many matches are scanned for islands of matches. Matches of a
multiple of q inside a run of period q are that run's and are taken off the multiple's count, so the multiples of a period are
scanned only where something else may repeat. A scan first looks at every q-th place, then at every quarter of that, and goes on
only while islands of the needed length remain possible.
"""

from __future__ import annotations

import hashlib
import zlib
from itertools import count

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import release, text_of

REPEATS = 4
LEAST = 6  # words of a run
PIECE = 1 << 18  # words counted together; a longer text stands alone
SHAPE = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs array<struct<start:int,length:int,period:int>>, collapsed string"


def needed(lags: np.ndarray, repeats: int = REPEATS, least: int = LEAST) -> np.ndarray:
    """Matches in a row that a run of each period has at least."""
    return np.maximum(least, repeats * lags) - lags


def heavy_from(n: int) -> int:
    """Occurrences from which pairs of a word's positions are more work than its transform."""
    return max(64, int((4 * n * np.log2(max(2, n))) ** 0.5))


def lag_counts(ids: np.ndarray, sizes: np.ndarray, repeats: int = REPEATS) -> list[np.ndarray]:
    """Of texts of ``sizes`` words that follow each other in ``ids``: for each the matches at lags 0, 1 .. size // repeats."""
    n, first = len(ids), np.cumsum(sizes) - sizes
    limits = sizes // repeats
    slot = np.cumsum(limits + 1) - limits - 1  # where a text's counts begin
    counts = np.zeros(int((limits + 1).sum()), np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((ids, doc))  # stable, so positions of one word of a text ascend
    key_doc, key_id = doc[order], ids[order]
    new = np.ones(n, bool)
    new[1:] = (key_doc[1:] != key_doc[:-1]) | (key_id[1:] != key_id[:-1])
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, n))
    frequent = size >= np.array([heavy_from(int(s)) for s in sizes])[key_doc[head]] if n else np.zeros(0, bool)
    light = np.repeat(~frequent, size)
    # rare words: the pair of each position with the one k places on, for ever larger k
    at, end = np.flatnonzero(light), np.repeat(head + size, size)
    k = 0
    while len(at):
        k += 1
        at = at[at + k < end[at]]
        lag = order[at + k] - order[at]
        fits = lag <= limits[key_doc[at]]  # later positions of the same word are farther still
        at, lag = at[fits], lag[fits]
        if len(at):
            counts += np.bincount(slot[key_doc[at]] + lag, minlength=len(counts))
    # frequent words: the power spectra of a text's words add up before one transform back
    for d in np.unique(key_doc[head[frequent]]):
        width = 1 << int(sizes[d] + limits[d]).bit_length()
        power = np.zeros(width // 2 + 1)
        for h in np.flatnonzero(frequent & (key_doc[head] == d)):
            mark = np.zeros(width)
            mark[order[head[h] : head[h] + size[h]] - first[d]] = 1
            spectrum = np.fft.rfft(mark)
            power += spectrum.real**2 + spectrum.imag**2
        counts[slot[d] : slot[d] + limits[d] + 1] += np.rint(np.fft.irfft(power, width)[: limits[d] + 1]).astype(np.int64)
    return [counts[s : s + m + 1] for s, m in zip(slot, limits)]


def islands(hit: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of at least ``least`` true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    long = end - start >= least
    return start[long], end[long]


def scan(ids: np.ndarray, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Islands of at least ``least`` matches at ``lag``, sought on a coarse grid of places first."""
    step = lag
    while step > 1:
        far = ids[lag::step]
        if not len(islands(ids[: (len(far) - 1) * step + 1 : step] == far, least // step)[0]):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        step //= 4
    return islands(ids[:-lag] == ids[lag:], least)


def runs_of(ids: np.ndarray, counts: np.ndarray, repeats: int = REPEATS, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every maximal run of one text, by start, then period."""
    lags = np.arange(len(counts))
    need = needed(lags, repeats, least)
    left, found, seen = counts.copy(), [], set()
    left[:1] = 0
    open_lags = np.flatnonzero(left >= need)
    while len(open_lags):
        lag = int(open_lags[0])
        for start, end in zip(*(x.tolist() for x in scan(ids, lag, int(need[lag])))):
            length = end - start + lag
            if (start, length) not in seen:  # else a run of a divisor of the lag
                seen.add((start, length))
                found.append((start, length, lag))
                multiples = lags[2 * lag :: lag]
                left[2 * lag :: lag] -= np.maximum(length - multiples, 0)
        open_lags = open_lags[1:]
        open_lags = open_lags[left[open_lags] >= need[open_lags]]
    return sorted(found, key=lambda r: (r[0], r[2]))


def repeated(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words as they are, or for one id in ten with a phrase repeated to the end (h % 10 == 0 for h = crc32 of the decimal id)."""
    if doc_id is None or not words:
        return words
    g, odd = divmod(zlib.crc32(b"%d" % doc_id), 10)
    if odd:
        return words
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    times, rest = divmod(len(words) - a, p)
    return words[:a] + words[a : a + p] * times + words[a : a + rest]


def found_in(texts: list[list[bytes]], repeats: int = REPEATS, least: int = LEAST):
    """For each text of words its runs and the words that stay."""
    index: dict[bytes, int] = {}
    sizes = np.array([len(t) for t in texts], np.int64)
    total = int(sizes.sum())
    ids = np.fromiter(map(index.setdefault, (w for t in texts for w in t), count()), np.int64, total)
    low = 0
    for words, counts in zip(texts, lag_counts(ids, sizes, repeats)):
        runs = runs_of(ids[low : low + len(words)], counts, repeats, least) if len(words) >= least else []
        low += len(words)
        if runs:
            cover = np.zeros(len(words) + 1, np.int32)
            for start, length, period in runs:
                cover[start + period] += 1
                cover[start + length] -= 1
            kept = (np.cumsum(cover)[:-1] == 0).tolist()
            words = [w for w, k in zip(words, kept) if k]
        yield runs, words


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeats: int = REPEATS, least: int = LEAST, prepare=None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_runs, start, length, period, exponent_milli, runs, collapsed.

    A run is a maximal stretch of words of smallest period q and at least max(``least``, ``repeats`` * q) words; ``runs`` lists
    all by start, then period, and the four columns before it describe the longest (ties: smallest start, then period; none:
    nulls). ``collapsed`` holds the words left when each run keeps its first q words, joined by one space. ``prepare`` (words,
    id) may change a text's words first. Null, empty and blank texts have no run and an empty ``collapsed``; rows with a null id
    and repeated rows are taken like any other, an empty table gives none, and other columns of ``docs`` are not read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).cast("binary").alias("t"))

    def work(batches):
        import pyarrow as pa

        def result(ids: list, texts: list):
            rows = []
            for i, (runs, words) in zip(ids, found_in(texts, repeats, least)):
                start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
                rows.append((i, len(runs), start, length, period, runs and 1000 * length // period or None, [dict(zip(("start", "length", "period"), r)) for r in runs], b" ".join(words).decode()))
            release()
            names = [c.split()[0] for c in SHAPE.split(", ")]
            part = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("period", pa.int32())])
            types = [pa.int64()] * 6 + [pa.list_(part), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            ids, texts, words = [], [], 0
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = (t.as_py() or b"").split()
                ids.append(i)
                texts.append(prepare(own, i) if prepare else own)
                words += len(own)
                if words >= PIECE:
                    yield result(ids, texts)
                    ids, texts, words = [], [], 0
            if ids:
                yield result(ids, texts)

    return source.mapInArrow(work, SHAPE)


def digests(found: DataFrame) -> DataFrame:
    """The result of ``periodic_runs`` with hashes in place of its lists and texts."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(list_reduce(list_transform([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: unicode(x)), lambda x: CAST(x AS BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS h FROM documents
), e AS (
  SELECT row, doc_id, w, h, len(w) AS n, h // 10 AS g, (h // 10) % greatest(len(w), 1) AS a FROM d
), f AS (
  SELECT row, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE w END AS w FROM e
), t AS (
  SELECT row, n, unnest(w) AS word, unnest(range(n)) AS i FROM f WHERE n >= 6
), m AS (
  SELECT x.row, x.i, y.i - x.i AS q FROM t x JOIN t y ON x.row = y.row AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), s AS (
  SELECT row, q, min(i) AS start, count(*) + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM m) GROUP BY row, q, island
  HAVING count(*) + q >= greatest(6, 4 * q)
), r AS (
  SELECT row, start, length, min(q) AS period FROM s GROUP BY row, start, length
), l AS (
  SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    arg_min({'start': start, 'length': length, 'period': period}, {'l': -length, 's': start, 'p': period}) AS top FROM r GROUP BY row
), c AS (
  SELECT row, list(DISTINCT i) AS gone FROM (SELECT row, unnest(range(start + period, start + length)) AS i FROM r) GROUP BY row
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(top.start AS BIGINT) AS start, CAST(top.length AS BIGINT) AS length, CAST(top.period AS BIGINT) AS period,
  CAST(1000 * top.length // top.period AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(list_transform(list_filter(list_zip(w, range(n)), lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]), ' ') END) AS collapsed_sha256
FROM f LEFT JOIN l USING (row) LEFT JOIN c USING (row)
"""
