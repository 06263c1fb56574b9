"""Reshaping of state tables: layouts of audits and rosters, long vaccine tables, ids and repeated rows."""

from __future__ import annotations

import re
import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.grades import colon_grades
from .contract import as_type

# Names of vaccines in column names, and the kind of figure that a column name tells.
VACCINES = [("dtap", "dtap"), ("polio", "polio"), ("mmr", "mmr"), ("varicella", "varicella"), ("hepb|hep_b", "hepb"), ("hib", "hib")]
METRICS = [("percent", "percent"), ("count|number", "count")]


def for_audit(df: DataFrame) -> DataFrame:
    """Columns of an audit out of year_source (``md_15_16``), total_k_students, count_vacc, med_exempt and rel_exempt.

    ``delayed`` is what enrollment leaves beyond the vaccinated and the exempt, at least 0; null if any of them is.
    """
    whole = {"enrollment": "total_k_students", "current": "count_vacc", "med_exempt": "med_exempt", "rel_exempt": "rel_exempt"}
    out = df.withColumn("year", F.concat(F.lit("20"), F.substring("year_source", 4, 2)).try_cast("int"))
    out = out.withColumns({c: as_type(F.col(of), "int") for c, of in whole.items()})
    left = F.col("enrollment") - (F.col("current") + F.col("med_exempt") + F.col("rel_exempt"))
    return out.withColumn("delayed", F.when(left.isNotNull(), F.greatest(left, F.lit(0))))


def state_roster(df: DataFrame, names: dict[str, str], types: dict[str, list[str]] | None = None, other: str = "private") -> DataFrame:
    """The columns ``names`` (new name: column of the table): five-digit zips, types by the table's labels, grades out of colon lists."""
    missing = [c for c in names.values() if c not in df.columns]
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    out = df.select(*[F.col(f"`{of}`").alias(c) for c, of in names.items()])
    if "zip" in names:
        out = out.withColumn("zip", F.nullif(F.regexp_extract(F.col("zip").cast("string"), r"^\d{5}", 0), F.lit("")))
    if types is not None and "school_type" in names:
        label = F.lit(other)
        for kind, labels in types.items():
            label = F.when(F.coalesce(F.col("school_type").isin(*labels), F.lit(False)), kind).otherwise(label)
        out = out.withColumn("school_type", label)
    return out.withColumn("grades", colon_grades(F.col("grades"))) if "grades" in names else out


def snake_columns(df: DataFrame) -> DataFrame:
    """Column names in lower case with underscores; ``DTaP`` in any spelling is dtap."""
    clean = lambda c: re.sub(r"d_?ta_?p", "dtap", re.sub(r"[^0-9a-z]+", "_", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", c.strip()).lower()).strip("_"))
    return df.toDF(*map(clean, df.columns))


def first_label(c: Column, rules: list[tuple[str, str]], other: str) -> Column:
    return F.coalesce(*[F.when(c.rlike(pattern), F.lit(label)) for pattern, label in rules], F.lit(other))


def long_vaccines(df: DataFrame) -> DataFrame:
    """One row per vaccine column: vaccine_metric, value, vaccine_type and metric_type; per cents above 1 become shares."""
    df = snake_columns(df)
    wide = [c for c in df.columns if any(re.search(p, c) for p, _ in VACCINES)]
    number = lambda c: F.col(c).cast("string").try_cast("double")
    rest = [c for c in df.columns if c not in wide]
    kept = [number(c).alias(c) if re.search("percent|total", c) else F.col(c) for c in rest]
    out = df.select(*kept, *[number(c).alias(c) for c in wide]).unpivot(rest, wide, "vaccine_metric", "value")
    out = out.withColumns({"vaccine_type": first_label(F.col("vaccine_metric"), VACCINES, "other"), "metric_type": first_label(F.col("vaccine_metric"), METRICS, "value")})
    out = out.withColumn("value", F.when((F.col("metric_type") == "percent") & (F.col("value") > 1), F.col("value") / 100).otherwise(F.col("value")))
    return out if "county" in df.columns else out.withColumn("county", F.lit(None).cast("string"))


def without_redacted(df: DataFrame, note: str = "excluded_note") -> DataFrame:
    """Rows without a note on redaction."""
    return df.where(F.col(note).isNull())


def zeros_for_letters(df: DataFrame) -> DataFrame:
    """The letter O as the digit 0 in columns that start with total_ or percent_."""
    return df.withColumns({c: F.translate(F.col(c).cast("string"), "oO", "00") for c in df.columns if c.startswith(("total_", "percent_"))})


def distinct_schools(df: DataFrame, columns: list[str], id_col: str) -> DataFrame:
    """One row per combination of ``columns``, that of the smallest id; nulls are equal."""
    order = Window.partitionBy(*columns).orderBy(F.col(id_col).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in df.columns if c not in columns])
    return df.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n").select(*columns, id_col)


def copies(df: DataFrame, n: int, name: str = "row_num") -> DataFrame:
    """Each distinct row ``n`` times, numbered from 1."""
    return df.distinct().withColumn(name, F.explode(F.sequence(F.lit(1), F.lit(n)))) if n else df.limit(0).withColumn(name, F.lit(None).cast("int"))


def chosen_types(present: list[str], wanted: list[str] | None) -> list[str]:
    """The wanted vaccine types (None: all) among those present, in lower case; unknown ones give a warning, none an error."""
    have = list(dict.fromkeys(t.strip().lower() for t in present if t is not None))
    if wanted is None:
        keep = have
    else:
        asked = list(dict.fromkeys(t.strip().lower() for t in wanted))
        unknown = [t for t in asked if t not in have]
        if unknown:
            warnings.warn("vaccine types not in the data: " + ", ".join(unknown), stacklevel=2)
        keep = [t for t in asked if t in have]
    if not keep:
        raise ValueError("none of the vaccine types are in the data; present: " + ", ".join(have))
    return keep


def folder_names(types: list[str]) -> list[str]:
    """Safe and different folder names of vaccine types."""
    out: list[str] = []
    for t in types:
        name = re.sub(r"[^a-z0-9]+", "_", t.lower()).strip("_") or "type"
        again, taken = name, 0
        while again in out:
            taken += 1
            again = f"{name}_{taken}"
        out.append(again)
    return out


def spread_ids(df: DataFrame, keys: list[str], id_col: str = "school_id", first: str = "row_id") -> DataFrame:
    """Missing ids filled from the key's first known one (by ``first``); keys without any get new ones after the largest.

    New ids follow the order of the keys; the numbered table has one row per such key, in ranges (``rosters.dense_id``).
    """
    from ..operators.rosters import dense_id

    known = F.min_by(F.col(id_col), F.when(F.col(id_col).isNotNull(), F.col(first)))
    by_key = df.groupBy(*keys).agg(known.alias("__known"))
    largest = df.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("__largest"))
    fresh = dense_id(by_key.where("__known is null").select(*keys), keys, "__at").join(F.broadcast(largest))  # one row
    fresh = fresh.select(*keys, (F.col("__largest") + F.col("__at")).alias("__new"))
    same = lambda other: [df[k].eqNullSafe(other[f"__{k}"]) for k in keys]
    renamed = lambda t: t.withColumnsRenamed({k: f"__{k}" for k in keys})
    by_key, fresh = renamed(by_key), renamed(fresh)
    out = df.join(by_key, same(by_key), "left").drop(*[f"__{k}" for k in keys])
    fresh_on = [out[k].eqNullSafe(fresh[f"__{k}"]) for k in keys]
    out = out.join(fresh, fresh_on, "left").drop(*[f"__{k}" for k in keys])
    return out.withColumn(id_col, F.coalesce(id_col, "__known", "__new").cast(df.schema[id_col].dataType)).drop("__known", "__new")


def filled_down_up(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """Nulls filled with the last value before them in their key, and those before the first value with that."""
    down = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy(key).orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    return df.withColumns({c: F.coalesce(F.last(c, True).over(down), F.first(c, True).over(up)) for c in columns})


def with_zip_county(df: DataFrame, crosswalk: DataFrame, counties: DataFrame, zip_col: str = "zip") -> DataFrame:
    """Adds the county that holds most of the row's zip (crosswalk: zip, fips, ratio; counties: fips, county); ties go to the smaller code."""
    five = lambda c: F.lpad(c.cast("string"), 5, "0")
    best = crosswalk.select(five(F.col("zip")).alias("__zip"), F.col("fips").cast("string").alias("__fips"), "ratio")
    best = best.groupBy("__zip").agg(F.min_by("__fips", F.struct(-F.col("ratio"), "__fips")).alias("__fips"))
    named = best.join(counties.select(F.col("fips").cast("string").alias("__fips"), "county"), "__fips", "left").select("__zip", "county")
    return df.withColumn("__zip", five(F.col(zip_col))).join(named, "__zip", "left").drop("__zip")


def county_zips(crosswalk: DataFrame, codes: DataFrame) -> DataFrame:
    """(state, fips, zip, ratio, county) of a zip crosswalk with the names of its counties (codes: state, county, fips)."""
    return crosswalk.join(codes.select("state", "fips", "county"), ["state", "fips"], "left")


def numbers(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The first number of each named column that the table has, in its type; other columns stay."""
    from ..functions.text import first_number

    return df.withColumns({c: first_number(F.col(c).cast("string")).try_cast(kind) for c, kind in columns.items() if c in df.columns})


def numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns that the table has as doubles; text that is no number gives null."""
    return df.withColumns({c: F.col(c).cast("string").try_cast("double") for c in columns if c in df.columns})


def state_years(df: DataFrame, contract) -> DataFrame:
    """The contract's columns of rows with someone enrolled and a count of vaccinated that is not zero; negative counts stay."""
    return contract.apply(df).where("enrollment > 0 and current <> 0")


# Canonical columns of a yearly record, required and optional, with their types.
RECORD = {"school_id": "id", "year": "year", "enrollment": "int", "current": "int", "med_exempt": "int", "rel_exempt": "int"}
RECORD_MORE = {
    "total_exempt": "int", "cnty_id": "id", "school_name": "string", "county_name": "string", "vaccine_type": "string", "school_type": "string", "school_level": "string",
    "level_code": "string", "excluded_note": "string", "addr_clean": "string", "city": "string", "zip": "string", "state": "string", "business_status": "string", "lat": "double", "lon": "double",
}


def year_number(c: Column) -> Column:
    """A year that is a number, else the first 19xx or 20xx in the text, row by row."""
    text = c.cast("string")
    return F.coalesce(text.try_cast("int"), F.regexp_extract(text, r"\b((?:19|20)\d{2})\b", 1).try_cast("int"))


def numbered(df: DataFrame, column: str) -> DataFrame:
    """Ids as integers: where any value is a whole number the others become null, else the distinct values are numbered in order.

    The distinct values are numbered in ranges and joined back, so that no task sees them all.
    """
    from ..operators.rosters import dense_id

    text = F.col(column).cast("string")
    whole = F.coalesce(text.rlike(r"^\s*-?\d+\s*$"), F.lit(False))
    any_whole = df.agg(F.coalesce(F.bool_or(whole), F.lit(False)).alias("__any"))
    values = dense_id(df.where(text.isNotNull()).select(text.alias("__value")).distinct(), ["__value"], "__number")
    joined = df.join(F.broadcast(any_whole)).join(values, text == F.col("__value"), "left")  # one row
    number = F.when(F.col("__any"), F.when(whole, F.trim(text)).try_cast("int")).otherwise(F.col("__number").cast("int"))
    return joined.withColumn(column, number).drop("__any", "__value", "__number")


def yearly_records(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The canonical record columns out of a state's own (``names``: canonical name to that of the table).

    Required ones must be there; optional ones are added where the table has them.
    """
    of = lambda c: names.get(c, c)
    missing = [of(c) for c in RECORD if of(c) not in df.columns]
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    kinds = RECORD | {c: k for c, k in RECORD_MORE.items() if of(c) in df.columns}
    typed = lambda c, kind: year_number(c) if kind == "year" else c if kind == "id" else as_type(c, kind)
    out = df.select(*[typed(F.col(f"`{of(c)}`"), kind).alias(c) for c, kind in kinds.items()])
    for c in [c for c, kind in kinds.items() if kind == "id"]:
        out = numbered(out, c)
    return out.select(*kinds)
