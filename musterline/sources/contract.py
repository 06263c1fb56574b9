"""Column contracts: what a table must have, may have, and of which types."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_type(c: Column, kind: str) -> Column:
    """The column in a type; text that is no number gives null, and whole numbers are cut, not rounded."""
    if kind in ("int", "bigint", "long"):
        return F.regexp_replace(c.cast("string"), "[,%]", "").try_cast("double").try_cast(kind)
    if kind == "double":
        return F.regexp_replace(c.cast("string"), "[,%]", "").try_cast("double")
    return c.cast(kind)


@dataclass(frozen=True)
class Contract:
    """Required and optional columns with their types; ``apply`` projects, coerces and names what is missing."""

    required: dict[str, str]
    optional: dict[str, str] = field(default_factory=dict)

    def apply(self, df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
        """``names`` maps a contract's column to that of the table."""
        of = lambda c: (names or {}).get(c, c)
        missing = [of(c) for c in self.required if of(c) not in df.columns]
        if missing:
            raise ValueError("missing columns: " + ", ".join(missing))
        kept = self.required | {c: t for c, t in self.optional.items() if of(c) in df.columns}
        return df.select(*[as_type(F.col(f"`{of(c)}`"), t).alias(c) for c, t in kept.items()])


def harmonized(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Exactly these columns in this order, null where the table lacks them."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in columns.items()])


def normalized_missing(df: DataFrame) -> DataFrame:
    """Text trimmed, blank as null."""
    return df.withColumns({c: F.nullif(F.trim(c), F.lit("")) for c, t in df.dtypes if t == "string"})


def redacted(df: DataFrame, note: str = "excluded_note") -> DataFrame:
    """A note on rows with a ``**`` cell; such cells and ``<10`` become null."""
    texts = [c for c, t in df.dtypes if t == "string" and c != note]
    starred = F.lit(False)
    for c in texts:
        starred = starred | F.coalesce(F.col(c).contains("**"), F.lit(False))
    old = F.col(note) if note in df.columns else F.lit(None).cast("string")
    out = df.withColumn(note, F.when(starred, "redacted").otherwise(old))
    return out.withColumns({c: F.when(~(F.col(c).contains("**") | F.coalesce(F.trim(c) == "<10", F.lit(False))), F.col(c)) for c in texts})
