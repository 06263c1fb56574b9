"""The corpus pipeline: five stages of operators from ``musterline.llm``, each working on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
A doc_id names one document: rows that share it are kept or dropped together. The stages that send texts to Python have the
session send at most ``BATCH_ROWS`` rows at once, as an executor holds several batches of whole texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from musterline.llm import langid, mixing, rankbpe, rlz, simhash
from musterline.llm.shared import erased, maybe_among, saved

BATCH_ROWS = 1000
MIN_SCORE = 0.4  # language predictions below this probability are rejected


def _tokenizer() -> str:
    from public_tokenizers import path

    return path("word_bpe_49k.json")


def _ready(spark: SparkSession) -> None:
    """Small batches, and a driver without the plans and broadcasts of the stages before, whose heap would stay at its largest."""
    erased(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts that are null, without letters or of no clear language go."""
    _ready(spark)
    found = langid.predict(docs, carry=docs.columns)
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE)).select("row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of texts whose five-word shingles are 0.8 alike or more.

    Null ids stay when nothing else names one of their groups. Only the text of documents that may go is moved.
    """
    _ready(spark)
    found = simhash.similar_documents(docs)
    stays = found.groupBy("doc_id").agg(F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("__stays"))
    gone = saved(stays.where(~F.col("__stays")).select(F.col("doc_id").alias("__gone")))
    asked = maybe_among(docs, F.xxhash64("doc_id"), gone.select(F.xxhash64("__gone").alias("__key")), "__asked")
    some = asked.where("__asked").drop("__asked")
    return asked.where("not __asked").drop("__asked").union(some.join(gone, some["doc_id"].eqNullSafe(gone["__gone"]), "left_anti"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur earlier; documents that consist of nothing else go."""
    _ready(spark)
    others = [c for c in docs.columns if c != "text"]
    found = rlz.substring_dedup(docs, carry=others).where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    size = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("row.n_chars"))
    new = {"text": F.col("kept"), "n_chars": size}
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: whole copies of documents, the one at a source's cut if half of it fits.

    Rows alike in id, source and text get the largest number of copies among them; texts without words are in no copy of a
    source that is not repeated.
    """
    _ready(spark)
    last = (F.col("part") > 0) & (2 * F.col("part") >= F.col("size"))
    mixed = mixing.mix(docs).select(F.col("doc_id").alias("__of"), F.col("source").alias("__from"), F.col("text_key").alias("__text"), (F.col("epochs") + last.cast("long")).alias("__n"))
    copies = mixed.groupBy("__of", "__from", "__text").agg(F.max("__n").alias("__copies")).where("__copies > 0")
    text = F.coalesce(docs["text"], F.lit(""))
    same = docs["doc_id"].eqNullSafe(copies["__of"]) & docs["source"].eqNullSafe(copies["__from"]) & (F.xxhash64(text, F.octet_length(text)) == copies["__text"])
    joined = docs.join(copies, same)
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digests of ids and of the text decoded from them."""
    _ready(spark)
    return rankbpe.encode(docs, _tokenizer(), ids=True, digests=True)


STAGES = [
    ("language ID", known_language),
    ("SimHash near-dedup", one_of_each),
    ("substring dedup", without_repeats),
    ("mixing sources to target weights", mixed_sources),
    ("BPE encoding and decoding", encoded),
]

ORACLE_SQL = None  # fingerprints, models and merges are beyond SQL; tests/llm hold each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with each stage's rows written once and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = saved(docs)
    return docs
