"""The older modular audit: named checks on a school-year table, with a summary of what needs review."""

from __future__ import annotations

import warnings
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import dqa

CHECKS = ("duplicates", "negatives", "exceeding_enrollment", "coverage_outliers", "enrollment_deviation", "vaccination_deviation", "extreme_outliers")
COUNTS = ("current", "delayed", "med_exempt", "rel_exempt")


class Audited(NamedTuple):
    summary: DataFrame
    results: dict[str, DataFrame]
    cleaned: DataFrame


def duplicate_rows(df: DataFrame, compared: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(identical, conflicting) rows of school-years that stand more than once."""
    found = dqa.duplicates(df, compared=compared)
    rows = lambda same: df.join(found.where(F.col("identical") == same).select("school_id", "year"), ["school_id", "year"], "left_semi")
    return rows(True), rows(False)


def signed_deviation(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """Rows farther than ``threshold`` from their school's mean, with the mean and the signed share; a mean of zero counts as infinitely far."""
    mean = F.avg(column).over(Window.partitionBy("school_id"))
    found = df.withColumn(f"mean_{column}", mean)
    gap = F.col(column) - F.col(f"mean_{column}")
    share = F.try_divide(gap, F.col(f"mean_{column}"))
    far = dqa.no((F.abs(share) > threshold) | ((F.col(f"mean_{column}") == 0) & (gap != 0)))
    return found.withColumn("pct_diff_from_mean", share).where(far)


def run_checks(df: DataFrame, checks: str | list[str] = "all", deviation_threshold: float = 0.5, coverage_threshold: float = 1.05, outlier_multiplier: float = 10) -> Audited:
    """The chosen checks over the table, whose identical repeats go first; unknown names give a warning.

    A check whose columns are missing is left out. Extreme rows are those strictly above the multiple of the median.
    """
    chosen = CHECKS if checks == "all" else [c for c in CHECKS if c in checks]
    unknown = [] if checks == "all" else [c for c in checks if c not in CHECKS]
    if unknown:
        warnings.warn("unknown checks: " + ", ".join(unknown), stacklevel=2)
    results, data, has = {}, df, lambda *c: all(x in df.columns for x in c)
    if "duplicates" in chosen and has("school_id", "year"):
        identical, results["duplicates_conflicting"] = duplicate_rows(df)
        results["duplicates_identical"] = identical
        data = df.distinct()  # rows equal in all columns; a table without any stays as it is
    counts = [c for c in COUNTS if c in df.columns]
    if "negatives" in chosen and (present := [*counts, *(["enrollment"] if has("enrollment") else [])]):
        results["negative_values"] = data.where(dqa.any_of([F.col(c) < 0 for c in present]))
    if "exceeding_enrollment" in chosen and counts:
        if not has("enrollment"):
            raise ValueError("exceeding_enrollment needs the column enrollment")
        results["exceeding_enrollment"] = data.where(dqa.any_of([F.col(c) > F.col("enrollment") for c in counts]))
    if "coverage_outliers" in chosen and has("current", "enrollment"):
        covered = data if has("mmr_coverage") else data.withColumn("mmr_coverage", dqa.coverage())
        results["coverage_outliers"] = covered.where((F.col("mmr_coverage") < 0) | (F.col("mmr_coverage") > coverage_threshold))
        if has(*COUNTS):
            results["over_coverage"] = covered.where(reduce(lambda x, y: x + y, map(F.col, COUNTS)) > F.col("enrollment"))
    for check, column in (("enrollment_deviation", "enrollment"), ("vaccination_deviation", "current")):
        if check in chosen and has("school_id", column):
            results[check] = signed_deviation(data, column, deviation_threshold)
    if "extreme_outliers" in chosen and has("school_id", "enrollment"):
        median = F.median("enrollment").over(Window.partitionBy("school_id"))
        results["extreme_outliers"] = data.withColumn("median_enroll", median).where(F.col("enrollment") > outlier_multiplier * F.col("median_enroll"))
    return Audited(tallied(df, data, results, deviation_threshold, coverage_threshold, outlier_multiplier), results, data)


def tallied(df: DataFrame, data: DataFrame, results: dict[str, DataFrame], deviation_threshold: float, coverage_threshold: float, outlier_multiplier: float) -> DataFrame:
    """(check, issue_count, action_type) of the checks in ``results``, as flags of one pass over the table and its windows."""
    school, flags = Window.partitionBy("school_id"), {}
    counts = [c for c in COUNTS if c in df.columns]
    covered = F.col("mmr_coverage") if "mmr_coverage" in df.columns else dqa.coverage()
    far = lambda c: dqa.no((F.abs(F.try_divide(F.col(c) - F.avg(c).over(school), F.avg(c).over(school))) > deviation_threshold) | ((F.avg(c).over(school) == 0) & (F.col(c) != F.avg(c).over(school))))
    ways = {
        "negative_values": lambda: dqa.any_of([F.col(c) < 0 for c in [*counts, *(["enrollment"] if "enrollment" in df.columns else [])]]),
        "exceeding_enrollment": lambda: dqa.any_of([F.col(c) > F.col("enrollment") for c in counts]),
        "coverage_outliers": lambda: (covered < 0) | (covered > coverage_threshold),
        "over_coverage": lambda: reduce(lambda x, y: x + y, map(F.col, COUNTS)) > F.col("enrollment"),
        "enrollment_deviation": lambda: far("enrollment"),
        "vaccination_deviation": lambda: far("current"),
        "extreme_outliers": lambda: F.col("enrollment") > outlier_multiplier * F.median("enrollment").over(school),
    }
    flags = {k: ways[k]() for k in results if k in ways}
    none = df.sparkSession.createDataFrame([], "check string, issue_count long")
    parts = [none]
    if flags:
        marked = data.select(*[dqa.no(c).cast("long").alias(k) for k, c in flags.items()])
        parts.append(marked.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in flags]).unpivot([], list(flags), "check", "issue_count"))
    if "duplicates_conflicting" in results:
        parts.append(results["duplicates_conflicting"].agg(F.lit("duplicates_conflicting").alias("check"), F.count("*").alias("issue_count")))
    return reduce(DataFrame.union, parts).withColumn("action_type", F.lit("requires_review"))


def consolidated(results: dict[str, DataFrame]) -> DataFrame:
    """All rows of all checks in one table, with the check's name first; columns that a check lacks are null."""
    parts = [r.select(F.lit(k).alias("dqa_check"), *r.columns) for k, r in results.items()]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
