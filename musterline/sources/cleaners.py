"""Cleaners that bring the rosters of states, departments and directories to the columns that linkage reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import grades, text
from ..functions.address import clean_address

PO_BOX_ACTIONS = ("blank", "drop", "keep")


def lowered(df: DataFrame) -> DataFrame:
    """All text in lower case."""
    return df.withColumns({c: F.lower(c) for c, t in df.dtypes if t == "string"})


def named(df: DataFrame, name: str = "school_name") -> DataFrame:
    """Adds school_level, told by the standard name, and school_name_std and county_std, the name without level words."""
    df, full = df.withColumn("__full", text.school_name(F.col(name))), F.col("__full")
    return df.withColumns({"school_name_std": text.without_level(full), "county_std": text.county_name(F.col("county")), "school_level": text.school_level(full)}).drop("__full")


def with_district(df: DataFrame, column: str = "district") -> DataFrame:
    return df.withColumn("district_std", text.district_name(F.col(column)) if column in df.columns else F.lit(None).cast("string"))


def charter(df: DataFrame, name: str = "school_name") -> DataFrame:
    """A school whose name says charter is of that type."""
    old = F.col("school_type") if "school_type" in df.columns else F.lit(None).cast("string")
    return df.withColumn("school_type", F.when(F.lower(name).contains("charter"), "charter").otherwise(old))


def addressed(df: DataFrame, column: str, suffix: str = "") -> DataFrame:
    bare = clean_address(F.col(column), keep_units=False, keep_directionals=False, case="lower")
    return df.withColumns({f"addr_clean{suffix}": clean_address(F.col(column), case="lower"), f"addr_clean{suffix}_no_unit": bare})


def level_match() -> Column:
    """A level code without pre-kindergarten where it also has elementary."""
    code = F.col("level_code")
    return F.when(code.contains(",e"), F.replace(code, F.lit("p,"), F.lit(""))).otherwise(code)


def eligible(df: DataFrame, elementary_only: bool, exclude_prek_only: bool) -> DataFrame:
    """Without schools that have neither e nor p, and without those that have p only, where asked."""
    if elementary_only:
        df = df.where(grades.elementary_eligible(F.col("level_code")))
    if exclude_prek_only:
        df = df.where(F.col("level_code").isNull() | (F.trim("level_code") != "p"))
    return df


def column_like(df: DataFrame, *words: str) -> str | None:
    """The first column whose name holds the first of these words that any column holds."""
    return next((c for w in words for c in df.columns if w in c.lower()), None)


def kindergarten(df: DataFrame) -> DataFrame:
    """State records (school_name, county, school_type, year_source, ..): address columns only if the table has some."""
    street, zip_code = column_like(df, "address", "street"), column_like(df, "zip")
    out = with_district(named(lowered(df)))
    out = charter(out.withColumn("level_code", grades.level_code_of_type(F.col("school_level"))))
    if street is not None:
        out = addressed(out, street)
        out = out.withColumn("zip", F.col(zip_code).cast("string") if zip_code else F.lit(None).cast("string"))
        out = out if "city" in out.columns else out.withColumn("city", F.lit(None).cast("string"))
    return out


def department(df: DataFrame, elementary_only: bool = False, exclude_prek_only: bool = False, level: Callable[[Column], Column] = grades.level_code) -> DataFrame:
    """A department's list (school_name, county, grades, street, ..)."""
    out = addressed(with_district(named(lowered(df))).withColumn("level_code", level(F.col("grades"))), "street")
    out = eligible(out, elementary_only, exclude_prek_only)
    return charter(out.withColumn("level_code_match", level_match()))


def directory(df: DataFrame, located: DataFrame | None = None, po_box: str = "blank", elementary_only: bool = False, exclude_prek_only: bool = False) -> DataFrame:
    """A web directory (id, name, county, schoolType, levelCode, street1, city, zip, lat, lon, ..).

    ``located`` (id, county_geo, zip_geo) comes from the points: its county overrides the directory's, except that post-office
    boxes without a point keep theirs. Such boxes lose their place (``blank``), go (``drop``) or stay (``keep``).
    """
    if po_box not in PO_BOX_ACTIONS:
        raise ValueError(f"po_box is one of {', '.join(PO_BOX_ACTIONS)}, not {po_box!r}")
    boxed = text.is_po_box(F.col("street1")) if "street1" in df.columns else F.lit(False)
    out = df.withColumn("po_box", boxed)
    if po_box == "drop":
        out = out.where(~F.col("po_box"))
    if po_box == "blank":
        out = out.withColumns({c: F.when(~F.col("po_box"), F.col(c)) for c in ("lat", "lon")})
    out = out.withColumnsRenamed({"name": "school_name", "schoolType": "school_type", "levelCode": "level_code"}).withColumn("zip", F.col("zip").cast("string"))
    district = "districtName" if "districtName" in out.columns else "district"
    out = addressed(with_district(named(out), district), "street1")
    out = eligible(out, elementary_only, exclude_prek_only)
    out = out.withColumns({"county_gs": F.col("county"), "county_gs_std": F.col("county_std")})
    if located is not None:
        out = out.join(located.select("id", "county_geo", "zip_geo"), "id", "left")
        geo = text.county_name(F.col("county_geo"))
        keep = F.col("po_box") & F.col("county_geo").isNull()
        out = out.withColumns({"county": F.when(keep, F.col("county")).otherwise(F.col("county_geo")), "county_std": F.when(keep, F.col("county_std")).otherwise(geo)})
    if po_box == "blank":
        out = out.withColumns({c: F.when(~F.col("po_box"), F.col(c)) for c in ("addr_clean", "addr_clean_no_unit")})
    return charter(out.withColumn("level_code_match", level_match()))
