"""A reference list out of two or three rosters by name cascades, and records matched to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import linkage
from .rosters import dense_id

ADDRESS = ("addr_clean", "street", "city", "zip")
# Block columns and the thresholds (nearest, lowest, outright) of each pass.
REFERENCE_PASSES = [
    ("address", ["addr_clean_no_unit", "school_type"], 0.3, 0.6, 0.15),
    ("zip", ["zip", "school_type", "level_code_match"], 0.25, 0.5, 0.15),
    ("city", ["city_cln", "school_type", "level_code_match"], 0.2, 0.5, 0.15),
    ("district", ["district_std", "school_type", "level_code_match"], 0.2, 0.5, 0.15),
    ("county", ["county_std", "school_type", "level_code_match"], 0.2, 0.5, 0.15),
]


def fills(column: str):
    """The condition that both sides have the column and some value in it."""

    def check(a: DataFrame, b: DataFrame) -> bool:
        return all(column in df.columns and not df.where(linkage.filled(column).isNotNull()).isEmpty() for df in (a, b))

    return check


def own_district() -> Column:
    """Rows whose district is known and is not the county."""
    return (linkage.filled("district_std").isNotNull()) & (F.col("district_std") != F.col("county_std"))


def passes(left_id: str, right_id: str, by_place: bool = True, city: bool = True, name: str = "school_name_std") -> list[linkage.Pass]:
    """Place first, then similar names in ever wider blocks."""
    out = [linkage.Pass("place_id", lambda a, b: linkage.by_key(a, b, "place_id", left_id, right_id), fills("place_id"))] if by_place else []
    for label, block, threshold, lowest, outright in REFERENCE_PASSES:
        if label == "city" and not city:
            continue
        near = lambda a, b, block=block, t=threshold, low=lowest, e=outright: linkage.fuzzy(a, b, name, block, left_id, right_id, low, t, e)
        district = label == "district"
        out.append(linkage.Pass(label, near, fills("district_std") if district else None, own_district() if district else None, own_district() if district else None))
    return out


def with_city(df: DataFrame) -> DataFrame:
    return df.withColumn("city_cln", F.lower(F.trim("city")))


def prefixed(df: DataFrame, suffix: str, keep: str) -> DataFrame:
    return df.select(keep, *[F.col(c).alias(f"{c}_{suffix}") for c in ("school_name", "school_name_std", "county", *ADDRESS) if c in df.columns])


def preferred_address(df: DataFrame, source: str) -> DataFrame:
    """Address columns of the preferred source (``doe`` or ``third``) where it has them."""
    if f"addr_clean_{source}" not in df.columns:
        return df
    return df.withColumns({c: F.coalesce(F.col(f"{c}_{source}").cast("string"), F.col(c).cast("string")) for c in ADDRESS if f"{c}_{source}" in df.columns})


def reference_key(directory: DataFrame, department: DataFrame, other: DataFrame | None = None, prefer: str | None = None) -> DataFrame:
    """All schools of the directory (data1_id), with the department's (data2_id) that each is, then the department's rest.

    A third source (data3_id) is matched to that list by address, zip, district and county, and its rest is appended.
    ``prefer`` says whose address counts (``doe`` or ``third``). school_id numbers the list.
    """
    one, two = with_city(directory), with_city(department)
    found = linkage.cascade(one, two, passes("data1_id", "data2_id"), "data1_id", "data2_id").matched
    links = found.select(F.col("orig_id_1").alias("data1_id"), F.col("orig_id_2").alias("data2_id"), F.col("pass").alias("match_pass"))
    out = directory.withColumn("source", F.lit("Great Schools")).join(linkage.sorted_in(links), "data1_id", "left").join(linkage.sorted_in(prefixed(department, "doe", "data2_id")), "data2_id", "left")
    rest = department.join(linkage.sorted_in(links.select("data2_id").distinct()), "data2_id", "left_anti").withColumn("source", F.lit("DOE"))
    out = out.unionByName(rest, allowMissingColumns=True)
    if other is not None:
        out = with_third(out, other)
    out = preferred_address(out, prefer) if prefer else out
    charter = F.when(F.lower("school_name").contains("charter"), "charter").otherwise(F.col("school_type"))
    return dense_id(out.withColumn("school_type", charter), ["school_name_std", "county_std", "data1_id", "data2_id"], "school_id")


def with_third(matched: DataFrame, other: DataFrame) -> DataFrame:
    """The list with the third source's columns on the schools that it names too, and its other schools after them."""
    keyed = dense_id(with_city(matched), ["school_name_std", "county_std", "data1_id", "data2_id"], "temp_id").checkpoint()
    found = linkage.cascade(with_city(other), keyed, passes("data3_id", "temp_id", by_place=False, city=False), "data3_id", "temp_id").matched
    one = linkage.first_per(found, ["orig_id_2"], "orig_id_1").select(F.col("orig_id_1").alias("data3_id"), F.col("orig_id_2").alias("temp_id"))
    out = keyed.join(linkage.sorted_in(one), "temp_id", "left").join(linkage.sorted_in(prefixed(other, "third", "data3_id")), "data3_id", "left").drop("temp_id", "city_cln")
    rest = other.join(linkage.sorted_in(found.select(F.col("orig_id_1").alias("data3_id")).distinct()), "data3_id", "left_anti")
    return out.unionByName(rest.withColumn("source", F.lit("Third")), allowMissingColumns=True)


def records_to_reference(schools: DataFrame, reference: DataFrame, district: bool = True) -> DataFrame:
    """(vacc_school_id, school_id, match_method): elementary schools of the records matched to the list by place and name.

    Schools that stay take the school of a matched one of the same county (and district) with a similar name.
    """
    elementary = lambda df: df.where(F.col("level_code").isNull() | F.col("level_code").contains("e"))
    left, right = elementary(schools), elementary(reference)
    near = lambda block, threshold, low: lambda a, b: linkage.fuzzy(a, b, "school_name_std", block, "vacc_school_id", "school_id", low, threshold, 0.10)
    steps = [
        linkage.Pass("place_id", lambda a, b: linkage.by_key(a, b, "place_id", "vacc_school_id", "school_id"), fills("place_id")),
        linkage.Pass("district_type", near(["county_std", "district_std", "school_type"], 0.169, 0.3), fills("district_std")),
        linkage.Pass("county_type", near(["county_std", "school_type"], 0.169, 0.3)),
        linkage.Pass("county", near(["county_std"], 0.15, 0.3)),
    ]
    found = linkage.cascade(left, right, steps, "vacc_school_id", "school_id").matched
    matched = found.select(F.col("orig_id_1").alias("vacc_school_id"), F.col("orig_id_2").alias("school_id"), F.col("pass").alias("match_method"))
    rest = left.join(matched.select("vacc_school_id"), "vacc_school_id", "left_anti")
    known = left.join(matched.select("vacc_school_id"), "vacc_school_id", "left_semi").withColumnRenamed("vacc_school_id", "known_id")
    block = ["county_std", *(["district_std"] if district and "district_std" in schools.columns else [])]
    own = linkage.fuzzy(rest, known, "school_name_std", block, "vacc_school_id", "known_id", 0.35, 0.20, 0.10).matched
    inherited = own.select(F.col("orig_id_1").alias("vacc_school_id"), F.col("orig_id_2").alias("__known"))
    inherited = inherited.join(matched.select(F.col("vacc_school_id").alias("__known"), "school_id"), "__known").select("vacc_school_id", "school_id", F.lit("self").alias("match_method"))
    return matched.unionByName(inherited)


def collapsed_records(schools: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(schools, crosswalk): schools of one place become one, with the columns of that whose years end last.

    Schools without a place stay alone. Years (array) and members (array) are united, records summed; new ids follow name and county.
    """
    place = F.coalesce(linkage.filled("place_id"), F.concat(F.lit("__row__"), F.col("vacc_school_id").cast("string")))
    rows = schools.withColumn("__group", place)
    order = F.struct(F.array_max("years"), (-F.col("vacc_school_id")).alias("i"))
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    grouped = rows.groupBy("__group").agg(
        *[F.max_by(c, order).alias(c) for c in columns], F.sum("n_records").alias("n_records"), union("years"), union("members"), F.count("*").cast("int").alias("n_collapsed"))
    numbered = dense_id(grouped, ["school_name_std", "county_std", "__group"], "new_id").checkpoint()
    links = rows.select("__group", F.col("vacc_school_id").alias("orig_id"), F.col("school_name_std").alias("orig_name_std"), "place_id")
    crosswalk = links.join(numbered.select("__group", "new_id", F.col("school_name_std").alias("new_name_std"), "n_collapsed"), "__group")
    crosswalk = crosswalk.select(F.lit("kinder").alias("source"), "orig_id", "orig_name_std", "place_id", "new_id", "new_name_std", "n_collapsed", (F.col("n_collapsed") > 1).alias("collapsed"))
    return numbered.withColumnRenamed("new_id", "vacc_school_id").drop("__group", "n_collapsed"), crosswalk
