"""Coverage survey files of children, teens and schools in one layout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.model_tables import statistics

LAYOUT = ("pop", "vaccine", "year", "year_type", "age_range", "n", "p", "x", "sd", "se")


def number(c: str):
    return F.nullif(F.regexp_extract(F.col(c).cast("string"), r"-?\d+\.?\d*", 0), F.lit("")).try_cast("double")


def _laid_out(df: DataFrame) -> DataFrame:
    return statistics(df).select(*LAYOUT)


def household_survey(df: DataFrame, state: str, pop: str, year_col: str, year_type: str) -> DataFrame:
    """Rows of one state by age, single years only, of columns vaccine, geography, dimension_type, dimension, estimate, sample_size."""
    rows = df.where((F.col("geography") == state) & (F.col("dimension_type") == "Age") & F.col(year_col).cast("string").rlike(r"^\d{4}$"))
    return _laid_out(rows.select(
        F.lit(pop).alias("pop"), "vaccine", F.col(year_col).cast("int").alias("year"), F.lit(year_type).alias("year_type"), F.col("dimension").alias("age_range"),
        number("sample_size").alias("n"), (number("estimate") / 100).alias("p")))


def school_survey(df: DataFrame, state: str) -> DataFrame:
    """Rows of one state of columns vaccine, geography, school_year, estimate, population, surveyed (per cent)."""
    rows = df.where(F.col("geography") == state)
    return _laid_out(rows.select(
        F.lit("school").alias("pop"), "vaccine", F.substring("school_year", 1, 4).try_cast("int").alias("year"), F.lit("school year").alias("year_type"), F.lit("Kindergarten").alias("age_range"),
        F.bround(number("population") * number("surveyed") / 100).alias("n"), (number("estimate") / 100).alias("p")))


def interval(df: DataFrame, column: str = "ci") -> DataFrame:
    """Adds lower and upper of a text such as ``81.2 to 90.4``."""
    parts = F.split(column, " to ")
    return df.withColumn("lower", F.get(parts, 0).try_cast("double")).withColumn("upper", F.get(parts, 1).try_cast("double"))


def combined(*surveys: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, surveys)


def save(spark: SparkSession, surveys: DataFrame, path: str) -> DataFrame:
    surveys.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def vaxview(spark: SparkSession, child: DataFrame, school: DataFrame, teen: DataFrame, state: str, path: str | None = None, pull: bool = False) -> DataFrame:
    """The three survey files of a state in one layout, kept at ``path`` if given. With ``pull`` they come with an interval in ``ci``, which is split."""
    split = interval if pull else (lambda df: df)
    child, school, teen = (split(df) if "ci" in df.columns else df for df in (child, school, teen))
    out = combined(household_survey(child, state, "child", "birth_year", "birth year"), school_survey(school, state), household_survey(teen, state, "teen", "survey_year", "survey year"))
    return out if path is None else save(spark, out, path)
