"""Linking a state's kindergarten records to one master list of schools, step by step as a lazy plan."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import linkage, rosters

PLACE = ("city", "addr_clean", "zip")
EXTRA = ("school_type", "level_code", "lat", "lon")
Locator = Callable[[DataFrame], DataFrame]  # adds place_id to rows of schools


class Standardized(NamedTuple):
    master: DataFrame
    schools: DataFrame
    matches: DataFrame
    joined: DataFrame
    unmatched: DataFrame


def nowhere(df: DataFrame) -> DataFrame:
    """The locator that knows no place."""
    return df.withColumn("place_id", F.lit(None).cast("string"))


def location_keys(df: DataFrame, label: str, id_col: str) -> DataFrame:
    """One row per name and location of a source: orig_id (the label and the smallest id), its columns, and all levels."""
    have = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) if c in df.columns else F.lit(None).cast("string")
    keys = ["school_name_std", "county_std", "district_std", *PLACE]
    rows = df.select(F.col(id_col).alias("__id"), "school_name", *[have(c).alias(c) for c in keys], *[have(c).alias(c) for c in EXTRA])
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("__id")))
    levels = rosters.level_union(F.array_join(F.collect_set("level_code"), ","))
    grouped = rows.groupBy(*keys).agg(
        F.min("__id").alias("__first"), F.min_by("school_name", "__id").alias("school_name"), F.count("*").alias("n_records"), levels.alias("level_code"),
        *[first(c).alias(c) for c in EXTRA if c != "level_code"])
    return grouped.withColumn("orig_id", F.concat(F.lit(f"{label}-"), F.col("__first").cast("string"))).drop("__first")


def collapsed(keys: DataFrame) -> DataFrame:
    """One row per place and set of meeting levels: the row with the smallest id, with the levels of all."""
    marked = linkage.collapse_places(keys, "orig_id")
    union = marked.groupBy("new_id").agg(rosters.level_union(F.array_join(F.collect_set("level_code"), ",")).alias("__levels"))
    return marked.where("orig_id = new_id").join(union, "new_id").withColumn("level_code", F.col("__levels")).drop("new_id", "__levels")


def absorbed(master: DataFrame, source: DataFrame, locate: Locator) -> DataFrame:
    """``master`` and those rows of ``source`` that match none of it by city or address, nor by place; levels of the latter are kept."""
    rest = linkage.exact(source, master, "school_name_std", ["city", "addr_clean"], "orig_id", "orig_id").left
    rest = collapsed(locate(rest)).checkpoint()
    by_place = linkage.by_key(rest, master, "place_id", "orig_id", "orig_id")
    gained = by_place.matched.join(rest.select(F.col("orig_id").alias("orig_id_1"), F.col("level_code").alias("__l")), "orig_id_1")
    gained = gained.groupBy(F.col("orig_id_2").alias("orig_id")).agg(F.array_join(F.collect_set("__l"), ",").alias("__l"))
    master = master.join(gained, "orig_id", "left").withColumn("level_code", rosters.level_union("level_code", "__l")).drop("__l")
    return master.unionByName(by_place.left).checkpoint()


def usable(df: DataFrame, columns) -> list[str]:
    """The columns that any row fills."""
    have = [c for c in columns if c in df.columns]
    row = df.agg(*[F.max(linkage.filled(c).isNotNull()).alias(c) for c in have]).first() if have else None
    return [c for c in have if row[c]]


def fuzzy_passes(left_id: str, right_id: str) -> list[linkage.Pass]:
    """District and type, county and type, county; the first only where both sides have districts."""

    def near(block, threshold):
        return lambda a, b: linkage.fuzzy(a, b, "school_name_std", block, left_id, right_id, 0.3, threshold, 0.10, level="level_code")

    both = lambda a, b: bool(usable(a, ["district_std"])) and bool(usable(b, ["district_std"]))
    return [
        linkage.Pass("fuzzy_district_type", near(["county_std", "district_std", "school_type"], 0.169), both),
        linkage.Pass("fuzzy_county_type", near(["county_std", "school_type"], 0.169)),
        linkage.Pass("fuzzy_county", near(["county_std"], 0.15)),
    ]


def standardize(records: DataFrame, directory: DataFrame, department: DataFrame, other: DataFrame | None = None, locate: Locator = nowhere,
                synonyms: Locator | None = None, directory_id: str = "data1_id", department_id: str = "data2_id", other_id: str = "data3_id") -> Standardized:
    """Cleaned tables (``sources.cleaners``) to a master list and the records with the school that each belongs to.

    The directory, the department's list and another source enter the master in this order. Schools of the records are
    matched on name and all the places they have, then by place, then again with slips of the county corrected, and what is left
    by similar names against elementary schools, which ``synonyms`` may list under further names. ``joined`` holds every record once: school_id is the master's, or
    ``vacc-`` and the record's own school. The records carry vacc_data_id and year_source.
    """
    records, directory, department = records.checkpoint(), directory.checkpoint(), department.checkpoint()  # cleaned once, read by several steps
    master = collapsed(locate(location_keys(directory, "dir", directory_id))).checkpoint()
    master = absorbed(master, location_keys(department, "doe", department_id), locate)
    if other is not None:
        master = absorbed(master, location_keys(other, "other", other_id), locate)

    plain = records.withColumn("school_type", F.replace("school_type", F.lit(" (non-public)"), F.lit("")))
    n_years = plain.agg(F.countDistinct("year_source").alias("n")).first()["n"]
    listed = directory.select("school_name_std").union(department.select("school_name_std"))
    every, members = rosters.unique_schools(plain, n_years, listed)
    members = members.checkpoint()
    schools = every.where(F.col("level_code").isNull() | F.col("level_code").contains("e"))
    places = [c for c in PLACE if c in records.columns]
    if places:
        schools = schools.join(rosters.modal_address(plain, members, places), "vacc_school_id", "left")
    schools = schools.withColumn("orig_id", F.concat(F.lit("vacc-"), F.col("vacc_school_id").cast("string"))).checkpoint()

    found, compared = [], ("county_std", "district_std", "city", "addr_clean")

    def keep(matched: DataFrame, method: str | None) -> DataFrame:
        hits = matched.select("orig_id_1", "orig_id_2", (F.lit(method) if method else F.col("pass")).alias("match_method")).checkpoint()
        found.append(hits)
        return hits

    def without(rows: DataFrame, hits: DataFrame) -> DataFrame:
        return rows.join(hits.select(F.col("orig_id_1").alias("orig_id")), "orig_id", "left_anti")

    rest, columns = schools, usable(schools, compared)
    if columns:
        rest = without(rest, keep(linkage.exact(rest, master, "school_name_std", columns, "orig_id", "orig_id", "all").matched, "exact"))
    rest = locate(rest).checkpoint()
    rest = without(rest, keep(linkage.by_key(rest, master, "place_id", "orig_id", "orig_id").matched, "place_id"))
    slips = rosters.county_slips(schools, "orig_id").drop("county_std")
    retried = rest.join(slips, "orig_id").withColumn("county_std", F.col("corrected_county_std")).drop("corrected_county_std")
    columns = usable(retried, compared)
    if columns:
        rest = without(rest, keep(linkage.exact(retried, master, "school_name_std", columns, "orig_id", "orig_id", "all").matched, "county_corrected"))
    elementary = master.where(F.col("level_code").isNull() | F.col("level_code").contains("e"))
    if synonyms is not None:
        elementary = synonyms(elementary).checkpoint()
    fuzzy = linkage.cascade(rest, elementary, fuzzy_passes("orig_id", "orig_id"), "orig_id", "orig_id")
    keep(fuzzy.matched, None)

    matches = reduce(DataFrame.union, found)
    carried = master.select(F.col("orig_id").alias("orig_id_2"), F.col("school_name").alias("school_name_master"), F.col("level_code").alias("level_code_master"), "lat", "lon", F.col("place_id"))
    linked = members.withColumn("orig_id_1", F.concat(F.lit("vacc-"), F.col("vacc_school_id").cast("string"))).join(matches, "orig_id_1", "left").join(carried, "orig_id_2", "left")
    linked = linked.withColumn("school_id", F.coalesce("orig_id_2", "orig_id_1")).drop("orig_id_1", "orig_id_2")
    dropped = [c for c in ("lat", "lon", "place_id", "school_id", "match_method") if c in records.columns]
    return Standardized(master, schools, matches, records.drop(*dropped).join(linked, "vacc_data_id", "left"), without(schools, matches))
