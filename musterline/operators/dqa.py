"""Audits of school-year tables: rules as named boolean columns, one pass for all of them, repairs and a ledger."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COUNTS = ("enrollment", "current", "med_exempt", "rel_exempt")


@dataclass(frozen=True)
class Rule:
    name: str
    broken: Column


def no(c: Column) -> Column:
    """A condition with null as false."""
    return F.coalesce(c, F.lit(False))


def any_of(conditions) -> Column:
    return no(F.greatest(*map(no, conditions))) if len(conditions) > 1 else no(conditions[0])


def coverage() -> Column:
    return F.try_divide(F.col("current"), F.col("enrollment"))


def exemptions() -> Column:
    """Medical plus religious exemptions, or the total where the table has one and a part is missing."""
    return F.col("med_exempt") + F.col("rel_exempt")


def row_rules(total: bool = False) -> list[Rule]:
    """The rules that need nothing but the row."""
    names = [*COUNTS, "total_exempt"] if total else list(COUNTS)
    taken = F.coalesce(exemptions(), F.col("total_exempt")) if total else exemptions()
    return [
        Rule("zero_enrollment", F.col("enrollment").isNull() | (F.col("enrollment") <= 0)),
        Rule("zero_current", F.col("current").isNull() | (F.col("current") == 0)),
        Rule("negative", any_of([F.col(c) < 0 for c in names])),
        Rule("too_high", any_of([F.col(c) > F.col("enrollment") for c in names[1:]])),
        Rule("coverage_outlier", no((coverage() < 0) | (coverage() > 1.05))),
        Rule("over_coverage", no(F.col("current") + taken > F.col("enrollment"))),
    ]


def broken(df: DataFrame, rule: Rule) -> DataFrame:
    return df.where(no(rule.broken))


def summary(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(check, issue_count) of every rule, from one pass over the table."""
    counted = df.agg(*[F.sum(no(r.broken).cast("long")).alias(r.name) for r in rules])
    return counted.unpivot([], [r.name for r in rules], "check", "issue_count").withColumn("issue_count", F.coalesce("issue_count", F.lit(0)).cast("long"))


def deviation(df: DataFrame, column: str, threshold: float = 0.5, key: str = "school_id") -> DataFrame:
    """Rows farther from their school's mean than the share ``threshold`` of it; a mean that is null or zero flags nothing."""
    mean = F.avg(column).over(Window.partitionBy(key))
    found = df.withColumn("mean", mean).withColumn("deviation", F.abs(F.col(column) - F.col("mean")) / F.nullif(F.col("mean"), F.lit(0.0)))
    return found.where(F.col("deviation") > threshold)


def with_history(df: DataFrame, flagged: DataFrame, key: str = "school_id") -> DataFrame:
    """All rows of the schools that ``flagged`` names."""
    return df.join(flagged.select(key).distinct(), key, "left_semi")


def extreme(df: DataFrame, column: str = "enrollment", multiple: float = 10, key: str = "school_id") -> DataFrame:
    """Rows at least ``multiple`` times, or at most that part of, their school's median."""
    found = df.withColumn("median", F.median(column).over(Window.partitionBy(key))).where(F.col("median") > 0)
    found = found.withColumn("ratio", F.col(column) / F.col("median"))
    kind = F.when(F.col("ratio") >= multiple, "high").when(F.col("ratio") <= 1 / multiple, "low")
    return found.withColumn("outlier_type", kind).where(kind.isNotNull())


def duplicates(df: DataFrame, keys: tuple[str, ...] = ("school_id", "year"), compared: list[str] | None = None) -> DataFrame:
    """Keys that stand more than once, how often, and whether their rows agree in the compared columns (by default the first ten)."""
    columns = [c for c in (compared or df.columns[:10]) if c not in keys]
    kinds = F.countDistinct(F.struct(*columns)) if columns else F.lit(1)
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"), kinds.alias("kinds")).where("n_rows > 1").select(*keys, "n_rows", (F.col("kinds") == 1).alias("identical"))


def largest_first(df: DataFrame, keys: tuple[str, ...] = ("school_id", "year"), by: str = "enrollment", ties: tuple[str, ...] = ()) -> DataFrame:
    """One row per key: the largest ``by``, then the smallest ``ties``."""
    order = Window.partitionBy(*keys).orderBy(F.col(by).desc_nulls_last(), *ties)
    return df.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def invalid_values(total: bool = False) -> dict[str, Column]:
    """The notes of impossible counts, in the order in which they are added."""
    e, c, m, r = map(F.col, COUNTS)
    sums = any_of([m > e, r > e, m + r > e])
    return {
        "current <0": no(c < 0), "current > enrollment": no(c > e),
        "exemptions > enrollment": sums | no(F.col("total_exempt") > e) if total else sums,
    }


def blank_invalid(df: DataFrame, note: str = "excluded_note") -> DataFrame:
    """Impossible counts set to null, with a note of each reason behind what the note held."""
    total = "total_exempt" in df.columns
    reasons = invalid_values(total)
    e, m, r = F.col("enrollment"), F.col("med_exempt"), F.col("rel_exempt")
    parts = any_of([m > e, r > e, m + r > e])
    old = F.nullif(F.col(note), F.lit("")) if note in df.columns else F.lit(None).cast("string")
    said = F.concat_ws("; ", old, *[F.when(c, F.lit(k)) for k, c in reasons.items()])
    new = {
        note: F.nullif(said, F.lit("")),
        "current": F.when(~(reasons["current <0"] | reasons["current > enrollment"]), F.col("current")),
        "med_exempt": F.when(~parts, m), "rel_exempt": F.when(~parts, r),
    }
    if total:
        new["total_exempt"] = F.when(~no(F.col("total_exempt") > e), F.col("total_exempt"))
    return df.withColumns(new)


def cap_current(df: DataFrame) -> DataFrame:
    """Current lowered to what the exemptions leave of enrollment."""
    room = F.col("enrollment") - exemptions()
    return df.withColumn("current", F.when(no(F.col("current") > room), room).otherwise(F.col("current")))


def ledger(df: DataFrame) -> DataFrame:
    """Every row with its ``exclusion_reason`` (null if kept) and the columns that were blanked as impossible.

    The reasons exclude one another in the order missing or zero enrollment, invalid or missing counts, none vaccinated.
    """
    total = "total_exempt" in df.columns
    fixed = {c: f"__{c}" for c in ("current", "med_exempt", "rel_exempt", *(["total_exempt"] if total else []))}
    blanked = blank_invalid(df.withColumns({f: F.col(c) for c, f in fixed.items()}))
    lost = [F.when(F.col(f).isNotNull() & F.col(c).isNull(), F.lit(c)) for c, f in fixed.items()]
    enough = F.col("med_exempt").isNotNull() & F.col("rel_exempt").isNotNull()
    if total:
        enough = enough | F.col("total_exempt").isNotNull()
    e = F.col("enrollment")
    short = F.col("current").isNull() | ~enough
    reason = (
        F.when(e.isNull(), "missing_enrollment").when(e <= 0, "zero_enrollment")
        .when(short & F.coalesce(*lost).isNotNull(), "invalid_count").when(short, "missing_count").when(F.col("current") == 0, "zero_vaccinated")
    )
    detail = F.when(e > 0, F.nullif(F.concat_ws(", ", *lost), F.lit("")))
    found = blanked.withColumn("exclusion_reason", reason).withColumn("blanked", detail)
    return found.withColumns({c: F.col(f) for c, f in fixed.items()}).drop(*fixed.values(), "excluded_note")
