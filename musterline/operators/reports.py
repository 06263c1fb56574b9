"""Reports on linked rosters: what lacks a place, what has closed, what was renamed, and why schools stay unmatched."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, has_street_address

# States of business that a report on closed schools lists.
CLOSED = ("closed_temporarily", "closed_permanently")


def missing_places(df: DataFrame, key: str = "school_id") -> DataFrame:
    """Rows that lack coordinates, a place or a state of business, with a flag for each."""
    lacks = lambda c: blank_to_null(F.col(c).cast("string")).isNull()
    flags = {"no_coordinates": lacks("lat") | lacks("lon"), "no_place_id": lacks("place_id"), "no_status": lacks("business_status")}
    return df.withColumns(flags).where(" or ".join(flags)).orderBy(F.col(key).asc_nulls_last())


def closed_schools(df: DataFrame, keys: tuple[str, ...] = ("school_id", "school_name"), year: str = "year") -> DataFrame:
    """Rows whose state of business says closed, with the latest such year of their school."""
    latest = F.max(year).over(Window.partitionBy(*keys))
    return df.where(F.col("business_status").isin(*CLOSED)).withColumn("latest_year", latest).orderBy("business_status", F.col("latest_year").desc_nulls_last(), *keys)


def missing_addresses(df: DataFrame, key: str = "school_id", name: str = "school_name_std") -> DataFrame:
    """Rows without a latitude or a numbered address, one per name and then per school; rows without a school all stay.

    Of several the first in the order of the table's columns stays.
    """
    rows = df.where(blank_to_null(F.col("lat").cast("string")).isNull() | ~has_street_address(F.col("addr_clean")))
    order = [F.col(key).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in df.columns if c != key]]
    first = lambda rows, by: rows.withColumn("__n", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where("__n = 1").drop("__n")
    rows = first(rows, name)
    return first(rows.where(F.col(key).isNotNull()), key).unionByName(rows.where(F.col(key).isNull()))


def renames(matched: DataFrame, left: str = "name_1", right: str = "name_2") -> DataFrame:
    """Matched pairs whose names differ, those matched by place first."""
    return matched.where(~F.col(left).eqNullSafe(F.col(right))).orderBy((F.col("pass") != "place_id").cast("int"), left)


def call_summary(calls: DataFrame, prices: DataFrame, by_caller: bool = False) -> DataFrame:
    """Requests, successes and failures of each service, the failures by code, and the list cost (prices: api, usd_per_1000)."""
    keys = ["api", *(["caller"] if by_caller else [])]
    codes = calls.where("code is not null").groupBy(*keys, "code").agg(F.sum("requests").alias("n"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("order"), "code", "n"))), lambda x: F.concat_ws(": ", x["code"], x["n"].cast("string")))
    failures = codes.groupBy(*keys).agg(F.array_join(listed, "; ").alias("failures"))
    total = calls.groupBy(*keys).agg(F.sum("requests").alias("requests"), F.sum(F.when(F.col("code").isNull(), F.col("requests")).otherwise(0)).alias("succeeded"))
    out = total.withColumn("failed", F.col("requests") - F.col("succeeded")).join(prices.select("api", "usd_per_1000"), "api", "left")
    return out.withColumn("cost", F.col("requests") * F.col("usd_per_1000") / 1000).drop("usd_per_1000").join(failures, keys, "left")


def preview(df: DataFrame, column: str, key: str, n: int = 5) -> DataFrame:
    """The ``n`` rows of the largest values, ties by key."""
    return df.orderBy(F.col(column).desc_nulls_last(), key).limit(n)


def unmatched_report(df: DataFrame, key: str = "school_id") -> DataFrame:
    """Rows without a school, by name and county."""
    return df.where(F.col(key).isNull()).orderBy(F.col("school_name").asc_nulls_last(), F.col("county_std").asc_nulls_last())


def with_metadata(summary: DataFrame, state: str | None, at: str | None) -> DataFrame:
    """The state and the time of a report before its columns; a null is left out."""
    first = {k: v for k, v in (("state", state), ("generated_at", at)) if v is not None}
    return summary.select(*[F.lit(v).alias(k) for k, v in first.items()], *summary.columns)


def summary_lines(counted: dict[str, int]) -> list[str]:
    """A report of counts as lines for a console, the largest first."""
    wide = max(map(len, counted), default=0)
    return [f"{name.ljust(wide)}  {n:>9,}" for name, n in sorted(counted.items(), key=lambda x: (-x[1], x[0]))]
