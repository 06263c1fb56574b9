"""The corpus queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cascade, chatlog, gridjoin, mixing, rlz, runs, urltrust, variants, vptree


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urltrust.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = cascade.base_metrics(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rules = {"base": F.col("base_failed"), **cascade.default_rules(n_words="n_words", n_symbols="n_symbols")}
    found = cascade.cascade(docs, rules, order=[r["rule"] for r in cascade.plan(docs, rules)])
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.sql(f"select -1L conv_id, t turn, r role, '{said}' text from values (0L, 'user'), (1L, 'assistant') as v(t, r)")
    log = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    # each row of the table is one complete message event
    events = log.select("conv_id", F.col("turn").alias("seq"), F.struct("turn", "role", F.monotonically_increasing_id()).alias("message_id"), F.lit("message").alias("kind"), "role", "text")
    return chatlog.chat_digests(chatlog.fold(events))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import predict

    return predict(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    from .rankbpe import encode

    return encode(table(spark, sf_dir, "documents"), path("word_bpe_49k.json"), ids=False, digests=True)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_hpylm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hpylm import score_documents

    return score_documents(table(spark, sf_dir, "documents"))


def op9_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"))


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rlz.substring_dedup(table(spark, sf_dir, "documents"), joined=True)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"), noise=True)


def op12_gridjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gridjoin.near_vectors(table(spark, sf_dir, "embeddings"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(runs.periodic_runs(table(spark, sf_dir, "documents"), prepare=runs.repeated))


QUERIES = {
    "op1_urls": op1_urls, "op2_quality": op2_quality, "op3_chats": op3_chats, "op4_langid": op4_langid, "op5_bpe": op5_bpe,
    "op6_simhash": op6_simhash, "op7_mixing": op7_mixing, "op8_hpylm": op8_hpylm, "op9_vptree": op9_vptree, "op10_substring": op10_substring,
    "op11_variants": op11_variants, "op12_gridjoin": op12_gridjoin, "op13_runs": op13_runs,
}
ORACLE: dict[str, str] = {
    "op1_urls": urltrust.ORACLE, "op2_quality": cascade.ORACLE, "op3_chats": chatlog.ORACLE, "op7_mixing": mixing.ORACLE, "op9_vptree": vptree.ORACLE, "op10_substring": rlz.ORACLE,
    "op11_variants": variants.ORACLE, "op12_gridjoin": gridjoin.ORACLE, "op13_runs": runs.ORACLE,
}
