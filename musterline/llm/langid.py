"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, everything but letters becomes a blank, and runs of one to three characters are hashed into
``FEATURES`` columns with weights (1 + log tf) * idf of unit length. Document frequencies cover all training text. The
classifier is trained by follow-the-regularised-leader with elastic-net penalties on at most about ``SAMPLE_DOCS``
labelled documents, spread evenly over the languages, and calibrated by one temperature on a part of them that it was not fitted to.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

from .shared import pieces, release, row_offsets

FEATURES = 1 << 15
GRAMS = 3
SAMPLE_DOCS = 3000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-4
UNKNOWN = "und"
MOST_LANGUAGES = 256  # the model, broadcast, has a quarter of a megabyte for each


class Grams:
    """Hashed n-gram counts of texts."""

    def __init__(self):
        self.letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)

    def rows(self, column):
        """(columns, counts) of each text of an Arrow string column in order; nothing for a text without letters."""
        offsets = row_offsets(column)
        for low, high in pieces(offsets, 1 << 20):
            texts = [(x or "").lower() for x in column.slice(low, high - low).to_pylist()]
            code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
            known = self.letter[code]
            code[~known] = 32
            ends = np.cumsum([len(t) for t in texts])
            letters = np.concatenate([[0], np.cumsum(known)])
            grams, x = [], code.astype(np.uint64)
            key = np.zeros(len(x), np.uint64)
            for n in range(1, GRAMS + 1):
                key = (key[:-1] if n > 1 else key) * np.uint64(0x100000001B3) + x[n - 1 :] + np.uint64(n)
                mixed = key * np.uint64(0x9E3779B97F4A7C15)
                grams.append((mixed >> np.uint64(64 - 15)).astype(np.int32))
            for start, end in zip(np.append(0, ends[:-1]), ends):
                if letters[end] == letters[start]:
                    yield None
                    continue
                count = np.zeros(FEATURES, np.int64)
                for n, g in enumerate(grams):
                    if end - start > n:
                        count += np.bincount(g[start : end - n], minlength=FEATURES)
                at = np.flatnonzero(count)
                yield at, count[at]


def weights(at: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(count)) * idf[at]
    return x / max(1e-12, float(np.sqrt(x @ x)))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], classes: int, seed: int = 0) -> np.ndarray:
    """Weights (features + 1 for the intercept, classes) after FTRL-proximal passes over (columns, values, class)."""
    z, n = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))

    def solved(at) -> np.ndarray:
        zz = z[at]
        return np.where(np.abs(zz) <= L1, 0.0, -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in order.permutation(len(examples)):
            at, x, y = examples[i]
            at, x = np.append(at, FEATURES), np.append(x, 1.0)
            w = solved(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p[None, :]
            square = g * g
            z[at] += g - (np.sqrt(n[at] + square) - np.sqrt(n[at])) / ALPHA * w
            n[at] += square
    return solved(np.arange(FEATURES + 1))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits that makes the held-back examples likeliest."""
    if not len(y):
        return 1.0
    grid = np.geomspace(0.25, 20, 121)
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fold: int = 0, folds: int = 5, carry: list[str] | None = None, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, and struct ``row`` of the columns in ``carry``.

    Learns from text and non-null language of rows whose crc32(id as text) mod ``folds`` is not ``fold``. ``lang_pred`` is a
    learned language with its calibrated probability, or ``und`` with score 0 for a text that is null or without a
    letter, and for every text if nothing could be learned. Null ids count as the empty text in the fold; repeated rows
    stay; an empty table gives no rows. More than ``MOST_LANGUAGES`` languages are an error. Columns of ``docs`` may have any names.
    """
    import pyarrow as pa

    text = F.coalesce(F.col(text_col), F.lit(""))
    held = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == fold
    learned = docs.where(~held & F.col(lang_col).isNotNull()).select(F.col(id_col).alias("id"), text.alias("text"), F.col(lang_col).alias("lang"))
    sizes = {r["lang"]: r["n"] for r in learned.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(sizes)

    def frequencies(batches):
        grams, total, n = Grams(), np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for found in grams.rows(batch.column(0)):
                if found:
                    total[found[0]] += 1
                    n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], names=["column", "n"])

    counted = learned.select("text").mapInArrow(frequencies, "column long, n long").groupBy("column").agg(F.sum("n").alias("n")).collect()
    frequency = np.zeros(FEATURES + 1, np.int64)  # the last place holds the number of texts
    for r in counted:
        frequency[r["column"]] = r["n"]
    idf = np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1

    share = max(1, sample_docs // max(1, len(languages)))
    chance = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, share / n)))]) if sizes else None
    model = None
    if sizes:
        drawn = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) < chance[F.col("lang")] * (1 << 30)

        def featured(batches):
            grams = Grams()
            for batch in batches:
                found = [f or (np.zeros(0, np.int32), np.zeros(0, np.int32)) for f in grams.rows(batch.column(0))]
                lists = [pa.array([f[i].astype(np.int32) for f in found], pa.list_(pa.int32())) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([batch.column(1), *lists, batch.column(2)], names=["lang", "at", "count", "key"])

        sample = learned.where(drawn).select("text", "lang", F.xxhash64("id", "text").alias("key")).mapInArrow(featured, "lang string, at array<int>, count array<int>, key long").toArrow().sort_by("key")
        number = {k: i for i, k in enumerate(languages)}
        examples = []
        for lang, at, count in zip(sample["lang"].to_pylist(), *[[x.values.to_numpy() for x in sample[c]] for c in ("at", "count")], strict=True):
            if len(at):
                examples.append((at.astype(np.int64), weights(at, count, idf), number[lang]))
        if examples:
            fitted, apart = [e for i, e in enumerate(examples) if i % 5], examples[::5]
            w = train(fitted or examples, len(languages))
            logits = np.array([x @ w[at] + w[FEATURES] for at, x, _ in apart])
            model = w, temperature(logits, np.array([y for _, _, y in apart]))
    shared = docs.sparkSession.sparkContext.broadcast((model, idf, languages))

    def work(texts):
        (model, idf, languages), grams = shared.value, Grams()
        for column in texts:
            names, scores = [], []
            for found in grams.rows(column):
                if found and model:
                    w, heat = model
                    p = softmax((weights(*found, idf) @ w[found[0]] + w[FEATURES]) / heat)
                    best = int(np.argmax(p))
                    names.append(languages[best])
                    scores.append(float(p[best]))
                else:
                    names.append(UNKNOWN)
                    scores.append(0.0)
            release()
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    judge = F.arrow_udf(work, "struct<lang_pred:string,score:double>", ArrowUDFType.SCALAR_ITER).asNondeterministic()  # evaluated once
    row = F.struct(*[F.col(f"`{c}`") for c in carry or [id_col]])
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"), judge(text).alias("p"), row.alias("row"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score", "row")
