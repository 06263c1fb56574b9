"""Look-ups at outside services: injected providers, a Parquet cache keyed by the query, and null-only patches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .service import Provider, Service, asked


def looked_up(df: DataFrame, keys: list[str], cache: DataFrame | None, provider: Provider | Service, schema: str, caller: str = "looked_up") -> tuple[DataFrame, DataFrame]:
    """(cache with the new answers, answers of all keys). Only distinct keys that the cache lacks reach the provider, each once, before this returns."""
    wanted = df.select(*keys).distinct()
    missing = wanted if cache is None else wanted.join(cache, keys, "left_anti")
    fresh = asked(missing, provider, schema, caller)
    known = fresh if cache is None else cache.unionByName(fresh, allowMissingColumns=True)
    return known, wanted.join(known, keys, "left")


def upsert(cache: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The cache with the new rows in place of those of the same key."""
    return cache.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def resolved_first(cache: DataFrame, key: str, value: str, when: str) -> DataFrame:
    """One row per key: those with a value before those without, then the latest."""
    order = Window.partitionBy(key).orderBy(F.col(value).isNull(), F.col(when).desc_nulls_last())
    return cache.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def patched(df: DataFrame, other: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Nulls of ``columns`` filled from ``other`` (one row per key)."""
    named = other.select(F.col(key), *[F.col(c).alias(f"__{c}") for c in columns])
    return df.join(named, key, "left").withColumns({c: F.coalesce(c, f"__{c}") for c in columns}).drop(*[f"__{c}" for c in columns])


def updated(df: DataFrame, other: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Columns overwritten by those of ``other`` (one row per key) where it has the key, nulls included."""
    named = other.select(F.col(key), F.lit(True).alias("__hit"), *[F.col(c).alias(f"__{c}") for c in columns])
    joined = df.join(named, key, "left")
    return joined.withColumns({c: F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)) for c in columns}).drop("__hit", *[f"__{c}" for c in columns])
