"""Group-wise summaries of rosters, reference directories and call logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null


def modal(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The most frequent value that is not blank, ties to the alphabetically first."""
    return df.groupBy(*keys).agg(F.mode(blank_to_null(F.col(column)), True).alias(column))


def majority(df: DataFrame, keys: list[str], column: str, share: float = 0.5) -> DataFrame:
    """Keys with the value that more than ``share`` of their rows have."""
    counted = df.groupBy(*keys, column).agg(F.count("*").alias("n"))
    part = F.col("n") / F.sum("n").over(Window.partitionBy(*keys))
    return counted.withColumn("__share", part).where(F.col("__share") > share).drop("n", "__share")


def fill_single(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Nulls filled where the rows of a key have exactly one distinct value; ``n_group`` counts the rows of the key."""
    group = Window.partitionBy(*keys)
    values = F.collect_set(column).over(group)
    return df.withColumn("n_group", F.count("*").over(group)).withColumn(column, F.when((F.col("n_group") > 1) & (F.size(values) == 1), values[0]).otherwise(F.col(column)))


def packed(df: DataFrame, keys: list[str], column: str, separator: str = "; ") -> DataFrame:
    """Sorted distinct values of each key in one text, and the number of rows."""
    return df.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(column)), separator).alias("packed"), F.count("*").alias("n_records"))


def unpacked(df: DataFrame, column: str, separator: str = "; ") -> DataFrame:
    """One row per packed value; null gives none."""
    return df.withColumn(column, F.explode(F.split(column, separator)))


def years_wide(df: DataFrame, key: str, years: list[int]) -> DataFrame:
    """Rows per key and year as columns, and in how many of the years the key stands."""
    wide = df.groupBy(key).pivot("year", years).count().na.fill(0)
    return wide.withColumn("n_years", reduce(lambda x, y: x + y, [(F.col(str(y)) > 0).cast("int") for y in years]))


def missing_years(df: DataFrame, key: str) -> DataFrame:
    """Years between a key's first and last that have no row."""
    span = df.groupBy(key).agg(F.min("year").alias("a"), F.max("year").alias("b")).select(key, F.explode(F.sequence("a", "b")).alias("year"))
    return span.join(df.select(key, "year").distinct(), [key, "year"], "left_anti")


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: n, missing, negative, zero, min, quartiles, mean and max."""
    long = df.unpivot([], columns, "column", "value")
    share = lambda c: F.sum(c.cast("long"))
    v = F.col("value")
    return long.groupBy("column").agg(
        F.count("*").alias("n"), share(v.isNull()).alias("n_missing"), share(F.coalesce(v < 0, F.lit(False))).alias("n_negative"), share(F.coalesce(v == 0, F.lit(False))).alias("n_zero"),
        F.min(v).cast("double").alias("low"), F.percentile(v, 0.25).alias("p25"), F.median(v).alias("mid"), F.round(F.avg(v), 6).alias("average"), F.percentile(v, 0.75).alias("p75"), F.max(v).cast("double").alias("high"),
    )


def directory_latest(df: DataFrame, key: str, open_states: dict[int, str]) -> DataFrame:
    """Per school of a yearly directory: latest name, all names (latest first), latest known place, and its state.

    A school that the newest edition does not list is closed. The newest year joins as a one-row table.
    """
    latest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("year")))
    names = F.array_distinct(F.transform(F.reverse(F.array_sort(F.collect_set(F.struct("year", "name")))), lambda x: x["name"]))
    grouped = df.groupBy(key).agg(F.max_by("name", "year").alias("name"), names.alias("names"), latest("lat").alias("lat"), latest("lon").alias("lon"), F.max("year").alias("last_seen"), F.max_by("status", "year").alias("status"))
    state = reduce(lambda c, kv: c.when(F.col("status") == kv[0], kv[1]), list(open_states.items()), F.when(F.col("last_seen") < F.col("newest"), "closed"))
    newest = df.agg(F.max("year").alias("newest"))
    return grouped.join(F.broadcast(newest)).withColumn("state", state).drop("newest", "status")  # one row


def billable(n: Column, before: Column, free: Column) -> Column:
    """Of ``n`` calls those beyond the free ones that ``before`` has left."""
    return F.greatest(before + n - free, F.lit(0)) - F.greatest(before - free, F.lit(0))


def repacked(df: DataFrame, keys: list[str], column: str, separator: str = "; ") -> DataFrame:
    """Packed lists of a key's rows as one list of their distinct values, sorted."""
    return packed(unpacked(df, column, separator), keys, column, separator).select(*keys, F.col("packed").alias(column))


def years_summary(df: DataFrame, years: list[int], series: str = "vaccine_type", key: str = "school_id", described: tuple[str, ...] = ()) -> DataFrame:
    """One row per series and key: rows of each of ``years``, in how many the key stands, whether some stand twice or lack, and which lack.

    A year lacks if the series has it for another key. Descriptions come from the key's latest year, of several rows the
    first in the order of their values. Rows without a key are left out.
    """
    rows = df.where(F.col(key).isNotNull())
    counts = [F.sum((F.col("year") == y).cast("long")).alias(str(y)) for y in years]
    have = rows.groupBy(series, key).agg(*counts, F.collect_set("year").alias("__have"))
    offered = rows.groupBy(series).agg(F.collect_set("year").alias("__all"))
    out = have.join(offered, have[series].eqNullSafe(offered[series])).drop(offered[series])
    lacking = F.array_sort(F.array_except("__all", "__have"))
    total = reduce(lambda x, y: x + y, [F.col(str(y)) for y in years])
    present = reduce(lambda x, y: x + y, [(F.col(str(y)) > 0).cast("int") for y in years])
    out = out.withColumns({"n_years": present, "n_rows": total, "years_missing": F.when(F.size(lacking) > 0, F.array_join(F.transform(lacking, lambda y: y.cast("string")), "; "))})
    out = out.withColumns({"has_duplicate_years": F.col("n_rows") > F.col("n_years"), "has_missing_years": F.col("years_missing").isNotNull()}).drop("__have", "__all")
    if described:
        latest = rows.groupBy(key).agg(F.max_by(F.struct(*described), F.struct("year", *described)).alias("__d"))
        out = out.join(latest, key).select(key, *[F.col(f"__d.{c}").alias(c) for c in described], *[c for c in out.columns if c != key])
    return out
