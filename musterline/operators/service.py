"""Paid look-ups asked once: answers are written before anything reads them, in small chunks, at a rate all tasks share.

Keys that have no final answer yet are claimed first: written down in waves of a chunk for each of ``slots`` tasks. A wave is asked
by that many tasks at once, and its answers are appended to the service's log before the next wave starts. After ``WAVES`` waves they grow
with what has been answered, so that their number grows with the logarithm of the keys.
Whoever needs an answer reads the log, so no plan that is run again asks again, and a run that was cut off asks only what the log
lacks: a wave in flight at most, which is a chunk a task or a small part of what it has answered. Spark repeats a lost task, and with it the questions of that task's chunk.
"""

from __future__ import annotations

import math
import re
import tempfile
import time
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .runlog import RunLog

Provider = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]
WAVES = 32  # of one chunk a task; each later one is as long as a part of so many of all before it
LOGGED = "asked_by string, asked_in string, asked_at timestamp"


def durable(spark: SparkSession) -> None:
    """Checkpoints go to the cluster's shared folder; to a temporary one only where it names none and the master is local."""
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="musterline-"))


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows written under ``path``, none if there is no such folder yet."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def paced(provider: Provider, share: float | None, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> Provider:
    """``provider`` with at most ``share`` questions a second: frames are cut to a second's worth, and each waits out its time."""
    if share is None:
        return provider
    burst = max(1, int(share))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for low in range(0, len(frame), burst):
                part, began = frame.iloc[low : low + burst].reset_index(drop=True), clock()
                yield part
                wait = len(part) / share - (clock() - began)  # asked for again when the provider has answered
                if wait > 0:
                    sleep(wait)

    return lambda frames: provider(cut(frames))


def chunked(provider: Provider, size: int) -> Provider:
    """``provider`` with frames of at most ``size`` rows."""
    return lambda frames: provider(f.iloc[low : low + size].reset_index(drop=True) for f in frames for low in range(0, len(f), size))


@dataclass(frozen=True)
class Service:
    """A provider with the log its answers go to.

    ``schema`` names the key first. ``final`` says which answers need no other (by default all), ``code`` what to count a failed one
    as. ``rate`` questions a second are shared out evenly among ``slots`` tasks, whatever the number of executors. ``log`` tallies
    the questions of every ``ask``.
    """

    api: str
    provider: Provider
    schema: str
    folder: str
    final: str = "true"
    code: str = "'no answer'"
    rate: float | None = None
    slots: int = 4
    chunk: int = 250
    log: RunLog | None = None

    @property
    def key(self) -> str:
        return self.schema.split()[0]

    def __post_init__(self):
        if self.rate is not None and not 0 < self.rate < float("inf"):
            raise ValueError("rate must be a positive, finite number of questions a second")
        if self.slots < 1 or self.chunk < 1:
            raise ValueError("slots and chunk must be positive")

    def every(self, spark: SparkSession) -> DataFrame:
        """All answers ever given, with who asked and when."""
        return read_log(spark, f"{self.folder}/answers", f"{self.schema}, {LOGGED}")

    def answers(self, spark: SparkSession) -> DataFrame:
        """One row per key: a final answer before others, then the latest."""
        order = Window.partitionBy(self.key).orderBy(~F.coalesce(F.expr(self.final), F.lit(False)), F.col("asked_at").desc(), "asked_in")
        return self.every(spark).withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n", *[c.split()[0] for c in LOGGED.split(", ")])

    def ask(self, keys: DataFrame, caller: str, again: bool = True) -> DataFrame:
        """The answers (one row per key asked for that has any) after those that lack a final one have been asked.

        Without ``again`` a key that has an answer of any kind is not asked again. Null keys are never asked.
        """
        spark, key = keys.sparkSession, self.key
        wanted = keys.select(key).where(F.col(key).isNotNull()).distinct()
        known = self.every(spark)
        known = known.where(F.coalesce(F.expr(self.final), F.lit(False))) if again else known
        name = uuid.uuid4().hex
        claimed = wanted.join(known.select(key).distinct(), key, "left_anti").repartition(self.slots, key).withColumn("at", F.monotonically_increasing_id())
        chunk = F.floor(F.col("at").bitwiseAND((1 << 33) - 1) / self.chunk)
        later = WAVES + F.floor(F.log(F.greatest(chunk, F.lit(WAVES)) / WAVES) / math.log(1 + 1 / WAVES))
        claimed = claimed.select(key, F.when(chunk < WAVES, chunk).otherwise(later).cast("long").alias("wave"))
        claimed.write.partitionBy("wave").parquet(f"{self.folder}/claims/{name}")
        claims = read_log(spark, f"{self.folder}/claims/{name}", f"{key} {dict(keys.dtypes)[key]}, wave long")
        last = claims.agg(F.max("wave")).first()[0]
        provider = chunked(paced(self.provider, None if self.rate is None else self.rate / self.slots), self.chunk)
        for wave in range(0 if last is None else last + 1):
            told = claims.where(F.col("wave") == wave).select(key).repartition(self.slots).mapInPandas(provider, self.schema)
            told = told.withColumns({"asked_by": F.lit(caller), "asked_in": F.lit(f"{name}-{wave:09d}"), "asked_at": F.current_timestamp()})
            told.write.mode("append").parquet(f"{self.folder}/answers")
        if self.log is not None:
            self.log.add(self.api, caller, *self.tally(spark, name))
        return self.answers(spark).join(wanted, key, "left_semi")

    def tally(self, spark: SparkSession, name: str) -> tuple[int, int, Counter]:
        """Questions of one ``ask`` that were answered, how many finally, and the others by code.

        Counted in the log, where an answer stands once however often a task or a plan was repeated.
        """
        rows = self.every(spark).where(F.col("asked_in").startswith(name))
        final = F.coalesce(F.expr(self.final), F.lit(False))
        codes = rows.groupBy(final.alias("good"), F.when(~final, F.expr(self.code)).alias("code")).agg(F.count("*").alias("n")).collect()
        return sum(r["n"] for r in codes), sum(r["n"] for r in codes if r["good"]), Counter({r["code"]: r["n"] for r in codes if not r["good"]})

    def rehearsal(self, spark: SparkSession, folder: str, provider: Provider, log: RunLog | None = None, use_cache: bool = True) -> Service:
        """The same service with ``provider`` in its place and a log of its own, which starts from what is known unless ``use_cache`` is off."""
        if use_cache:
            self.every(spark).write.mode("overwrite").parquet(f"{folder}/answers")
        return replace(self, provider=provider, folder=folder, rate=None, log=log)


def asked(keys: DataFrame, provider: Provider | Service, schema: str, caller: str, again: bool = True) -> DataFrame:
    """Answers for distinct ``keys``: of a service from its log, of a plain provider asked at once and checkpointed, so that no reader asks it again."""
    if isinstance(provider, Service):
        return provider.ask(keys, caller, again)
    durable(keys.sparkSession)
    return keys.distinct().mapInPandas(provider, schema).checkpoint()
