"""The last step of a state's roster: clean table, excluded rows, audits and model tables of each vaccine series."""

from __future__ import annotations

import uuid
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators import dqa
from ..operators.service import durable
from ..sources import reshape
from . import model_tables


class Finalized(NamedTuple):
    cleaned: DataFrame
    excluded: DataFrame
    summary: DataFrame
    deviations: DataFrame
    extremes: DataFrame
    observations: DataFrame
    surveys: DataFrame | None


def finalize(df: DataFrame, surveys: DataFrame | None = None, enrollment_share: float = 1.0, current_share: float = 0.75, multiple: float = 10) -> Finalized:
    """All tables of one series; nothing runs until one of them is written.

    Every input row is either in ``excluded``, with the reason, or its repaired form is in the clean table. Means and medians
    are taken after repeated school-years are reduced to the largest and current is capped.
    """
    judged = dqa.ledger(df)
    excluded = judged.where(F.col("exclusion_reason").isNotNull())
    kept = dqa.blank_invalid(judged.where(F.col("exclusion_reason").isNull()).drop("exclusion_reason", "blanked")).drop("excluded_note")
    one = dqa.largest_first(kept)
    capped = dqa.cap_current(one)
    far = dqa.deviation(capped, "enrollment", enrollment_share).withColumn("check", F.lit("enrollment"))
    far = far.unionByName(dqa.deviation(capped, "current", current_share).withColumn("check", F.lit("current")))
    spread = None if surveys is None else model_tables.spread_cohorts(model_tables.survey_rows(surveys))
    rules = dqa.row_rules("total_exempt" in df.columns)
    return Finalized(kept, excluded, dqa.summary(one, rules), far, dqa.extreme(capped, multiple=multiple), model_tables.observations(capped), spread)


MOST_SERIES = 200  # more different values than this are not vaccine series


def series_of(df: DataFrame, series: str, wanted: list[str] | None) -> list[str]:
    """The wanted series among those present, in lower case; unknown ones give a warning, none an error."""
    present = [r[0] for r in df.select(F.lower(F.trim(F.col(series)))).where(F.col(series).isNotNull()).distinct().limit(MOST_SERIES + 1).collect()]
    if len(present) > MOST_SERIES:
        raise ValueError(f"{series} has more than {MOST_SERIES} values")
    if not present or wanted and not {w.strip().lower() for w in wanted} & set(present):
        raise ValueError(f"no series of {wanted} in {sorted(present)}")
    return reshape.chosen_types(sorted(present), wanted or None)


def finalize_series(df: DataFrame, series: str, wanted: list[str] | None = None, surveys: DataFrame | None = None) -> dict[str, Finalized]:
    """``finalize`` for each series, or for those wanted (case and blanks around do not matter); none found is an error."""
    return {s: finalize(df.where(F.lower(F.trim(F.col(series))) == s), surveys if "mmr" in s else None) for s in series_of(df, series, wanted)}


def finalize_all(df: DataFrame, series: str, wanted: list[str] | None = None, enrollment_share: float = 1.0, current_share: float = 0.75, multiple: float = 10) -> dict[str, DataFrame]:
    """The tables of ``finalize`` for all series in one plan, each with the column ``series``; the rows are read and judged once.

    A school counts once per series, so every mean, median and repeated school-year stays within its series.
    """
    durable(df.sparkSession)
    chosen = series_of(df, series, wanted)
    rows = df.withColumn("series", F.lower(F.trim(F.col(series)))).where(F.col("series").isin(chosen)).withColumn("school_id", F.struct("series", "school_id"))
    rows = rows if series == "series" else rows.drop(series)
    judged = dqa.ledger(rows).checkpoint()
    plain = lambda t: t.withColumn("school_id", F.col("school_id.school_id"))
    excluded = judged.where(F.col("exclusion_reason").isNotNull())
    kept = dqa.blank_invalid(judged.where(F.col("exclusion_reason").isNull()).drop("exclusion_reason", "blanked")).drop("excluded_note")
    one = dqa.largest_first(kept)
    capped = dqa.cap_current(one)
    far = dqa.deviation(capped, "enrollment", enrollment_share).withColumn("check", F.lit("enrollment"))
    far = far.unionByName(dqa.deviation(capped, "current", current_share).withColumn("check", F.lit("current")))
    rules = dqa.row_rules("total_exempt" in df.columns)
    counted = one.groupBy("series").agg(*[F.sum(dqa.no(r.broken).cast("long")).alias(r.name) for r in rules])
    summary = counted.unpivot(["series"], [r.name for r in rules], "check", "issue_count")
    return {
        "cleaned": plain(kept), "excluded": plain(excluded), "summary": summary, "deviations": plain(far),
        "extremes": plain(dqa.extreme(capped, multiple=multiple)),
    }


MANIFEST = "run string, written_at timestamp, table string, series string, path string, n_rows long"


def write_final(df: DataFrame, series: str, folder: str, wanted: list[str] | None = None, surveys: DataFrame | None = None, **settings) -> DataFrame:
    """Writes the tables of ``finalize_all`` under ``folder``, a folder per table and series, and gives the manifest of the run.

    A run writes into a folder of its own and enters the manifest last, in one commit, so a reader of the manifest never sees half a
    run; what broke off stays unseen. Tables without rows of a series have no folder, and no line. MMR series bring the surveys' cohorts.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    tables = finalize_all(df, series, wanted, **settings)
    if surveys is not None:
        names = [s for s in series_of(df, series, wanted) if "mmr" in s]
        if names:
            tables["surveys"] = model_tables.spread_cohorts(model_tables.survey_rows(surveys)).withColumn("series", F.explode(F.array(*map(F.lit, names))))
    kinds = series_of(df, series, wanted)
    folders = F.create_map(*[F.lit(x) for pair in zip(kinds, reshape.folder_names(kinds)) for x in pair])
    lines = []
    for name, rows in tables.items():
        target = f"{folder}/run={run}/{name}"
        rows.withColumn("of", folders[F.col("series")]).repartition("of").write.partitionBy("of").parquet(target)
        counts = spark.read.schema(StructType([*rows.schema.fields, StructField("of", StringType())])).parquet(target).groupBy("series", "of").agg(F.count("*").alias("n_rows"))
        lines.append(counts.select(F.lit(run).alias("run"), F.current_timestamp().alias("written_at"), F.lit(name).alias("table"), "series", F.concat(F.lit(f"{target}/of="), "of").alias("path"), "n_rows"))
    manifest = reduce(DataFrame.union, lines).coalesce(1)
    manifest.write.mode("append").parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").where(F.col("run") == run)


def read_final(spark: SparkSession, folder: str, table: str, series: str) -> DataFrame:
    """A table of a series as the newest whole run left it."""
    lines = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").where((F.col("table") == table) & (F.col("series") == series.strip().lower()))
    newest = lines.orderBy(F.desc("written_at"), "run").first()
    if newest is None:
        raise ValueError(f"no {table} of {series} in {folder}")
    return spark.read.parquet(newest["path"])
