"""Spelling variants: words one edit apart, found by a rare-first prefix filter over positional bigrams.

One edit touches at most two bigrams of a word. Where bigrams are ordered by their frequency among all words, rarest first and
equal ones by position, two words one edit apart therefore share one of the three rarest of each, at positions at most one
apart. Words are joined on such bigrams only: a word meets words of its own length that have the bigram at the same position,
and words one longer that have it there or one further on. Letters are compared where they meet, block by block, so that only
true pairs leave the join.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from heapq import nsmallest

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import release, saved, text_buffers, text_of

PREFIX = 3
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
CHUNK = 4096  # words of one bigram, place and length that meet others at once
BUCKET_ROWS = 1 << 16
PAIRS = 1 << 20
FLUSH = 1 << 18  # distinct words a task holds before it sends their counts on

def misspelt(word: str, h: int) -> str:
    """The word without its code point ``h`` % length."""
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, noise: bool = False) -> DataFrame:
    """(word, n): the runs of letters of all texts with at least so many code points and occurrences.

    With ``noise`` a run of a document loses a code point where 199 divides the crc32 of ``<id>:<run>``; of a null id none does.
    """
    source = docs.select(F.col(id_col).cast("string").alias("id"), text_of(text_col).cast("binary").alias("t"))
    run = re.compile(f"[a-zÀ-ÿ]{{{max(1, least_length)},}}")  # a shorter run is no word, and none becomes longer

    def work(batches):
        import pyarrow as pa

        def sent(counts: Counter):
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

        counts: Counter = Counter()
        crc32 = zlib.crc32
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = run.findall((t.as_py() or b"").lower().decode())
                counts.update(own)
                if noise and i is not None and own:
                    distinct, prefix = list(dict.fromkeys(own)), crc32(f"{i}:".encode())
                    struck = [(w, h) for w, b in zip(distinct, " ".join(distinct).encode().split(b" ")) if not (h := crc32(b, prefix)) % 199]
                    for w, h in struck:
                        n = own.count(w)
                        counts[w] -= n
                        if len(less := misspelt(w, h)) >= least_length:
                            counts[less] += n
                if len(counts) >= FLUSH:
                    yield sent(counts)
                    counts = Counter()
            release()
        yield sent(counts)

    return source.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def bigrams(word: str) -> list[str]:
    return [word[i : i + 2] for i in range(len(word) - 1)]


def prefixes(words: DataFrame) -> DataFrame:
    """(letters, n, length, grams) of ``words`` (word, n): the word as Latin-1, and the (gram, pos) of its rarest bigrams.

    The frequencies come from all words. There are at most 90 * 90 different bigrams of these letters, so their counts go to
    every task.
    """
    def counted(batches):
        import pyarrow as pa

        for batch in batches:
            own = Counter(g for w in batch.column(0).to_pylist() for g in bigrams(w))
            yield pa.RecordBatch.from_arrays([pa.array(own.keys(), pa.string()), pa.array(own.values(), pa.int64())], names=["gram", "n"])

    every = words.select("word").mapInArrow(counted, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    often = {r["gram"]: r["n"] for r in every.collect()}

    def rarest(batches):
        import pyarrow as pa

        part = pa.list_(pa.struct([("gram", pa.int32()), ("pos", pa.int32())]))
        for batch in batches:
            own = batch.column(0).to_pylist()
            grams = [[{"gram": ord(g[0]) << 8 | ord(g[1]), "pos": i} for _, g, i in nsmallest(PREFIX, ((often[g], g, i) for i, g in enumerate(bigrams(w))))] for w in own]
            letters = pa.array([w.encode("latin-1") for w in own], pa.binary())
            yield pa.RecordBatch.from_arrays([letters, batch.column(1), pa.array(map(len, own), pa.int32()), pa.array(grams, part)], names=["letters", "n", "length", "grams"])

    return words.select("word", "n").mapInArrow(rarest, "letters binary, n long, length int, grams array<struct<gram:int,pos:int>>")


def matches(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and b, one word a row and as long or one longer in b, that are exactly one edit apart."""
    length, more = a.shape[1], b.shape[1] - a.shape[1]
    if not more:
        differ = np.zeros((len(a), len(b)), np.uint8 if length < 256 else np.int64)
        for x, y in zip(a.T, b.T):
            differ += x[:, None] != y
        return np.nonzero(differ == 1)
    # so many letters agree from the front and from the back that they meet
    agreed = np.zeros((len(a), len(b)), np.uint8 if 2 * length < 256 else np.int64)
    for columns in (zip(a.T, b.T), zip(a.T[::-1], b.T[::-1])):
        going = np.ones(agreed.shape, bool)
        for x, y in columns:
            going &= x[:, None] == y
            agreed += going
    return np.nonzero(agreed >= length)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, na, b, nb): every pair of ``words`` (word, n) one inserted, deleted or replaced code point apart, once.

    Words are of a-z and U+00C0 to U+00FF, need at least four code points each (three bigrams), and repeated words must have been
    counted together. Words that share a bigram meet in blocks of ``CHUNK`` of either side, so that a bigram many words have is
    many tasks' work.
    """
    listed = saved(prefixes(words)).withColumn("g", F.explode("grams")).drop("grams")
    index = listed.select("letters", "n", "length", F.lit(0).alias("more"), F.col("g.gram").alias("gram"), F.col("g.pos").alias("pos"), F.lit(True).alias("held"))
    place = F.explode(F.array(*[F.struct(F.lit(x).alias("more"), F.lit(y).alias("on")) for x, y in ((0, 0), (1, 0), (1, 1))]))
    probe = listed.withColumn("p", place).select(
        "letters", "n", (F.col("length") + F.col("p.more")).alias("length"), F.col("p.more").alias("more"), F.col("g.gram").alias("gram"), (F.col("g.pos") + F.col("p.on")).alias("pos"), F.lit(False).alias("held"),
    )
    key = ["gram", "pos", "length"]
    rows = index.unionByName(probe)
    sizes = saved(rows.groupBy(*key).agg(F.count(F.when(F.col("held"), 1)).alias("n_held"), F.count(F.when(~F.col("held"), 1)).alias("n_asked")))
    cut = lambda n: F.ceil(F.col(n) / CHUNK)
    hot = sizes.where((F.greatest("n_held", "n_asked") > CHUNK) & (F.least("n_held", "n_asked") > 0)).select(*key, cut("n_held").alias("s"), cut("n_asked").alias("t"))
    load = sizes.agg(F.sum(F.ceil(F.col("n_held") / CHUNK) * F.col("n_asked") + F.ceil(F.col("n_asked") / CHUNK) * F.col("n_held"))).first()[0] or 0
    buckets = int(load // BUCKET_ROWS) + 1
    # the same chunk of a side goes to every chunk of the other
    own, other = (F.coalesce(F.when(F.col("held"), F.col(x)).otherwise(F.col(y)), F.lit(1)) for x, y in ("st", "ts"))
    spread = rows.join(hot, key, "left").withColumn("x", F.pmod(F.xxhash64("letters"), own)).withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), other - 1)))
    at = [F.when(F.col("held"), F.col(x)).otherwise(F.col(y)) for x, y in ("xy", "yx")]
    dealt = spread.select("letters", "n", "more", "held", *key, at[0].alias("s"), at[1].alias("t"), F.pmod(F.xxhash64(*key, *at), F.lit(buckets)).cast("int").alias("bucket"))

    def verify(table):
        import pyarrow as pa

        release()
        raw, offsets = text_buffers(table["letters"])
        more, held, *own = (table[c].to_numpy().astype(np.int64) for c in ("more", "held", *key, "s", "t"))
        order = np.lexsort([more, held, *own])
        change = np.any([np.diff(x[order]) != 0 for x in own], axis=0)
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), len(order)]
        asked_of, held_of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for low, high in zip(bounds[:-1], bounds[1:]):  # words that share one bigram, those that ask before those that are held
            rows = order[low:high]
            n = int(np.count_nonzero(held[rows] == 0))
            if not 0 < n < len(rows):
                continue
            length = int(own[2][rows[0]])
            b = raw[offsets[rows[n:], None] + np.arange(length)]
            for some in (rows[:n][more[rows[:n]] == x] for x in (0, 1)):
                step = max(1, PAIRS // len(b))
                for i in range(0, len(some), step):
                    part = some[i : i + step]
                    x, y = matches(raw[offsets[part, None] + np.arange(length - more[part[0]])], b)
                    asked_of.append(part[x])
                    held_of.append(rows[n + y])
        x, y = np.concatenate(asked_of), np.concatenate(held_of)
        word = np.array(table["letters"].to_pylist(), object)
        once = (more[x] == 1) | (word[x] < word[y]) if len(x) else np.zeros(0, bool)
        x, y, n = x[once], y[once], table["n"].to_numpy()
        a, b = (pa.array([w.decode("latin-1") for w in word[z]], pa.string()) for z in (x, y))
        return pa.table({"a": a, "na": n[x], "b": b, "nb": n[y]})

    return dealt.groupBy("bucket").applyInArrow(verify, "a string, na long, b string, nb long").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last of the forms that follow each other.

    Every round doubles the steps a word has taken; a form has at least five times its word's count, so there are few.
    """
    reached = saved(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = saved(reached.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        reached = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return reached


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: bool = False, ratio: int = RATIO) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are as in ``word_counts``. ``n_near`` counts the words one edit away; ``form`` is the one of these with most
    occurrences (ties: smallest in code-point order) if it has at least ``ratio`` times the word's, ``form_n`` its number; ``root``
    is the end of the chain of forms, the word itself where it has none. Null, empty and letterless texts give no words; repeated rows count
    again; an empty table gives no rows. Other columns of ``docs`` are not read.
    """
    words = saved(word_counts(docs, id_col, text_col, noise=noise))
    pairs = saved(near_pairs(words))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("near_n")).union(pairs.select("b", "a", "na"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top"))
    joined = saved(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(-F.col("top.less") >= ratio * F.col("n"), F.col("top")).alias("top"),
    ).select("word", "n", "n_near", F.col("top.near").alias("form"), (-F.col("top.less")).alias("form_n")))
    found = joined.join(roots(joined.where("form is not null")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = r"""
WITH r AS (
  SELECT doc_id, unnest(list_transform(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+'), lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS w FROM documents
), o AS (
  SELECT doc_id, w, count(*) AS n FROM r GROUP BY doc_id, w
), h AS (
  SELECT w, n, xor(list_reduce([4294967295] || flatten(list_transform(string_split(doc_id || ':' || w, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, CAST(unicode(x) - 64 AS BIGINT)] END)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS h FROM o
), c AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % len(w)) || substr(w, h % len(w) + 2) ELSE w END AS word, n FROM h
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM c WHERE len(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), d AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS less FROM (SELECT word, n, unnest(range(len(word))) AS i FROM v)
), p AS (
  SELECT x.word, y.word AS near, y.n AS near_n FROM d x JOIN d y ON x.less = y.less AND x.i = y.i AND x.word <> y.word
  UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.less = v.word
  UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.less = v.word
), b AS (
  SELECT word, count(*) AS n_near, arg_min(near, {'n': -near_n, 'w': near}) AS near, max(near_n) AS near_n FROM p GROUP BY word
), f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * v.n THEN near END AS form, CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n FROM v LEFT JOIN b USING (word)
), g AS (
  WITH RECURSIVE up AS (
    SELECT word, word AS at FROM f UNION ALL SELECT up.word, f.form FROM up JOIN f ON f.word = up.at WHERE f.form IS NOT NULL
  ) SELECT up.word, up.at AS root FROM up JOIN f ON f.word = up.at WHERE f.form IS NULL
)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN g ON g.word = f.word
"""
