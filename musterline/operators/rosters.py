"""Rosters of schools out of yearly records: one row per school, corrected types and levels, and county slips."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rollups import fill_single

KEYS = ("school_name_std", "county_std", "school_type", "school_level", "level_code", "district_std")


def dense_id(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds 1..n in the order of ``order`` (ties in any order): ranges are numbered apart and shifted by their prefix sums.

    The rows are checkpointed first, so both passes see the same ranges; only one row per range meets in one task.
    """
    ranged = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()).checkpoint()
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("__size"))
    shift = F.sum("__size").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    shifts = sizes.select("__range", F.coalesce(shift, F.lit(0)).alias("__shift"))
    numbered = ranged.withColumn("__n", F.row_number().over(Window.partitionBy("__range").orderBy(*order)))
    return numbered.join(F.broadcast(shifts), "__range").withColumn(name, F.col("__n") + F.col("__shift")).drop("__n", "__shift", "__range")  # a row per range


def same(left: str, right: str, columns) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def unique_schools(records: DataFrame, n_years: int, listed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(schools, members) of yearly records with the columns ``KEYS``, school_name, year_source and vacc_data_id.

    A level, then a type, that is missing is filled where the group's other rows agree on one. A type that more than half
    of a group's records have replaces the others if the group has at most ``n_years`` records. With ``listed`` (the names
    of the reference rosters) rows of several types whose name is not listed become one private school. Schools get
    vacc_school_id, n_records, years and the first name; members link each record (vacc_data_id) to its school.
    """
    keys = list(KEYS)
    first = records.groupBy(*keys).agg(F.count("*").alias("n"), F.collect_set("year_source").alias("years"), F.min("school_name").alias("school_name"))
    rows = first.withColumns({f"was_{c}": F.col(c) for c in keys})
    rows = fill_single(rows, ["school_name_std", "county_std", "school_type"], "school_level")
    rows = fill_single(rows, ["school_name_std", "county_std", "school_level"], "school_type").drop("n_group")
    group = Window.partitionBy(*[k for k in keys if k != "school_type"])
    share = F.sum("n").over(Window.partitionBy(*keys)) / F.sum("n").over(group)
    rows = rows.withColumn("__total", F.sum("n").over(group)).withColumn("__share", share)
    ruling = F.max(F.when(F.col("__share") > 0.5, F.col("school_type"))).over(group)
    rows = rows.withColumn("school_type", F.when(F.col("__total") <= n_years, F.coalesce(ruling, "school_type")).otherwise(F.col("school_type"))).drop("__total", "__share")
    if listed is not None:
        known = listed.select(F.col("school_name_std").alias("__known")).where("__known <> ''").distinct()
        rows = rows.join(known, F.col("school_name_std") == F.col("__known"), "left")
        place = Window.partitionBy("school_name_std", "county_std", "district_std")
        kinds = F.size(F.collect_set(F.coalesce("school_type", F.lit(""))).over(place))
        rows = rows.withColumn("__merge", (kinds > 1) & F.col("__known").isNull()).drop("__known")
        merged = {"school_type": F.lit("private"), "school_level": F.min("school_level").over(place), "level_code": F.min("level_code").over(place)}
        rows = rows.withColumns({c: F.when(F.col("__merge"), v).otherwise(F.col(c)) for c, v in merged.items()}).drop("__merge")
    schools = rows.groupBy(*keys).agg(F.sum("n").alias("n_records"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("years")))).alias("years"), F.min("school_name").alias("school_name"))
    schools = dense_id(schools, keys, "vacc_school_id").checkpoint()
    became = rows.alias("r").join(schools.alias("s"), same("r", "s", keys)).select(*[F.col(f"r.was_{c}").alias(c) for c in keys], "vacc_school_id")
    members = records.alias("r").join(became.alias("s"), same("r", "s", keys)).select(F.col("r.vacc_data_id"), "vacc_school_id")
    return schools, members


def county_slips(schools: DataFrame, id_col: str = "vacc_school_id") -> DataFrame:
    """(id, county_std, corrected_county_std) of schools whose county looks like a slip.

    The same name stands in several counties; one has the most records (of ties the first by name), and a lesser county
    has none of that county's years. Blank names and counties take no part.
    """
    named = schools.where("school_name_std is not null and county_std <> ''")
    totals = named.groupBy("school_name_std", "county_std").agg(F.sum("n_records").alias("n"), F.array_distinct(F.flatten(F.collect_list("years"))).alias("years"))
    name = Window.partitionBy("school_name_std")
    ranked = totals.withColumn("__top", F.max("n").over(name)).withColumn("__first", F.row_number().over(name.orderBy(F.desc("n"), "county_std")))
    ruling = ranked.where("__first = 1").select("school_name_std", F.col("county_std").alias("corrected_county_std"), F.col("years").alias("ruling_years"))
    slips = ranked.where("n < __top").join(ruling, "school_name_std").where(~F.arrays_overlap("years", "ruling_years"))
    return named.select(id_col, "school_name_std", "county_std").join(slips.select("school_name_std", "county_std", "corrected_county_std"), ["school_name_std", "county_std"]).drop("school_name_std")


def modal_address(records: DataFrame, members: DataFrame, columns: list[str]) -> DataFrame:
    """The most frequent value of each address column over a school's records, blank ones left out."""
    joined = members.join(records.select("vacc_data_id", *columns), "vacc_data_id")
    return joined.groupBy("vacc_school_id").agg(*[F.mode(F.nullif(F.trim(F.col(c)), F.lit("")), True).alias(c) for c in columns])


def level_union(*codes: Column) -> Column:
    """The distinct level codes of several lists in order p, e, m, h; null if there are none."""
    every = F.concat_ws(",", *codes)
    kept = F.array_join(F.array_compact(F.array(*[F.when(every.contains(k), F.lit(k)) for k in "pemh"])), ",")
    return F.nullif(kept, F.lit(""))


def reaggregated(schools: DataFrame, keys: list[str], lists: list[str]) -> DataFrame:
    """Schools that agree in ``keys`` as one: records summed, lists united, and new ids by name and county."""
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    grouped = schools.groupBy(*keys).agg(F.sum("n_records").alias("n_records"), *[union(c) for c in lists])
    first = [c for c in ("school_name_std", "county_std") if c in keys]
    return dense_id(grouped, [*first, *[k for k in keys if k not in first]], "vacc_school_id")
