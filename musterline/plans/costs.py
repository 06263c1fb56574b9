"""What a run's look-ups would cost: requests counted without sending any, scaled, and priced beyond the free ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.prices import SERVICES
from ..operators.rollups import billable


def services(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SERVICES, "api string, usd_per_1000 double, free_per_month long, factor double")


def would_ask(df: DataFrame, keys: list[str], cache: DataFrame | None = None) -> DataFrame:
    """One row with the number of distinct look-ups that the cache lacks; nothing is sent."""
    wanted = df.select(*keys).distinct()
    missing = wanted if cache is None else wanted.join(cache.select(*keys).distinct(), keys, "left_anti")
    return missing.agg(F.count("*").alias("requests"))


def month_to_date(history: DataFrame, month: str) -> DataFrame:
    """Requests of each service in a month (yyyy-mm) of the call history (api, requests, run_date)."""
    return history.where(F.date_format("run_date", "yyyy-MM") == month).groupBy("api").agg(F.sum("requests").alias("prior"))


def estimate(counted: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """Expected and highest cost per service of counted requests (api, requests), before and after the free calls of the month."""
    spark = counted.sparkSession
    table = services(spark).join(counted.select("api", "requests"), "api", "left")
    table = table.withColumn("prior", F.lit(0)) if prior is None else table.join(prior, "api", "left")
    table = table.na.fill(0, ["requests", "prior"]).withColumn("expected", F.bround(F.col("requests") * F.col("factor")).cast("long"))

    def usd(n: Column) -> Column:
        return F.round(n * F.col("usd_per_1000") / 1000, 2)

    paid = lambda c: usd(billable(F.col(c), F.col("prior"), F.col("free_per_month")))
    return table.select(
        "api", F.col("requests").alias("requests_ceiling"), F.col("expected").alias("requests_expected"), F.col("prior").alias("requests_before"),
        usd(F.col("expected")).alias("usd_list_expected"), usd(F.col("requests")).alias("usd_list_ceiling"),
        paid("expected").alias("usd_after_free_expected"), paid("requests").alias("usd_after_free_ceiling"))
