"""The model's input tables: a location tree, observations, their populations, and survey rows spread over birth cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Years before the survey year of each cohort, its weight, by population.
COHORTS = {
    "child": [(0, 0.67), (-1, 0.33)],
    "teen": [(-19, 0.052941176), (-18, 0.196078431), (-17, 0.196078431), (-16, 0.196078431), (-15, 0.196078431), (-14, 0.162745098)],
    "school": [(0, 1.0)],
}
DOSES = {"child": 1, "teen": 2, "school": 2}
SKIPPED_AGES = ("13 Months", "19 Months")


def survey_rows(df: DataFrame) -> DataFrame:
    """MMR rows of the survey with a sample and a share, without the combined series and the two youngest ages."""
    v = F.lower("vaccine")
    return df.where(v.contains("mmr") & ~v.contains("pac") & ~F.coalesce(F.col("age_range").isin(*SKIPPED_AGES), F.lit(False)) & F.col("n").isNotNull() & F.col("p").isNotNull())


def spread_cohorts(df: DataFrame) -> DataFrame:
    """One row per birth cohort of a survey row (pop, year, age_range, ..): adds cohort, life_year, weight and dose."""
    pairs = F.create_map(*[x for k, v in COHORTS.items() for x in (F.lit(k), F.array(*[F.struct(F.lit(o).alias("o"), F.lit(w).alias("w")) for o, w in v]))])
    rows = df.withColumn("__c", F.explode(F.coalesce(pairs[F.col("pop")], F.array(F.struct(F.lit(0).alias("o"), F.lit(None).cast("double").alias("w"))))))
    cohort = F.col("year") + F.col("__c.o")
    life = (
        F.when(F.col("age_range") == "24 Months", 2).when(F.col("age_range") == "35 Months", 3).when(F.col("pop") == "school", 5)
        .when(F.col("pop") == "teen", (F.col("year") - F.col("cohort") - 1).cast("int"))
    )
    dose = F.create_map(*[F.lit(x) for kv in DOSES.items() for x in kv])[F.col("pop")]
    return rows.withColumn("cohort", cohort).withColumn("life_year", life).withColumn("weight", F.col("__c.w")).withColumn("dose", dose).drop("__c")


def statistics(df: DataFrame) -> DataFrame:
    """Adds x (half to even), sd and se of a share p of n."""
    p, n = F.col("p"), F.col("n")
    return df.withColumns({"x": F.bround(p * n), "sd": F.sqrt(p * (1 - p)), "se": F.sqrt(p * (1 - p) / n)})


def location_tree(schools: DataFrame) -> DataFrame:
    """(loc_id, parent_id, level) of schools (state, county, school_id): text paths as ids, the state at the root."""
    state, county = F.col("state"), F.concat_ws("/", "state", "county")
    rows = lambda i, parent, level: schools.select(i.alias("loc_id"), parent.cast("string").alias("parent_id"), F.lit(level).alias("level")).distinct()
    school = F.concat_ws("/", county, F.col("school_id").cast("string"))
    return rows(state, F.lit(None), "state").union(rows(county, state, "county")).union(rows(school, county, "school"))


def observations(df: DataFrame, age: int = 5, dose: int = 2) -> DataFrame:
    """Observations of a cleaned school-year table with their population and link: positive and sample_n per school and year."""
    return df.where(F.col("school_id").isNotNull()).select(
        F.concat_ws("-", F.col("school_id").cast("string"), F.col("year").cast("string")).alias("obs_id"), "school_id", "year",
        F.col("current").alias("positive"), F.col("enrollment").alias("sample_n"), (F.col("year") - age).alias("cohort"),
        F.lit(age).alias("age"), F.lit(dose).alias("dose"), F.lit(1.0).alias("weight"),
    )
