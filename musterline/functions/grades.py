"""Grade spans and level codes (p, e, m, h)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import once

LEVELS = ("p", "e", "m", "h")


def span(low: Column, high: Column) -> Column:
    """Codes from ``low`` to ``high`` (1 to 4), downwards if ``low`` is larger; null if either is."""
    codes = lambda e: F.transform(F.sequence(e["low"], e["high"]), lambda i: F.element_at(F.array(*map(F.lit, LEVELS)), i))
    return once(F.struct(low.alias("low"), high.alias("high")), lambda e: F.when(e["low"].isNotNull() & e["high"].isNotNull(), F.array_join(codes(e), ",")))


# Grades that open and close a span of each level, and patterns of a type's lowest and highest level.
LOWEST = [("pk", "tk"), ("k", "0", "1", "2", "3", "4", "5"), ("6", "7", "8"), ("9", "10", "11", "12")]
HIGHEST = [("pk", "tk"), ("k", "0", "1", "2", "3", "4", "5", "6"), ("7", "8"), ("9", "10", "11", "12")]
TYPE_LEVELS = [
    r"^pk$| pk$| pk/| pk and ",
    r"^elementary$|elementary/| elementary$| elementary and | elem$| elem/| elem and | elm$| elm and | elm/| es$| es/",
    r"^middle$| middle$|/middle$|middle/| middle and ",
    r"^high$| high$|/high$|high/| hs$|/hs$",
]


def level_code(grades: Column) -> Column:
    """Level codes of a grade span such as ``PK-5`` or ``6, 8``; grades compare as text, so ``01`` is none. Grade 6 opens a middle span but closes an elementary one."""
    text = F.regexp_replace(F.regexp_replace(F.lower(grades), " & ungraded|grades: ", ""), "prek", "pk")
    tokens = F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), ",| |-")
    level = lambda token, table: F.coalesce(*[F.when(token.isin(*names), i) for i, names in enumerate(table, 1)])
    return once(tokens, lambda t: span(once(F.element_at(t, 1), lambda x: level(x, LOWEST)), once(F.element_at(t, -1), lambda x: level(x, HIGHEST))))


def level_code_of_type(text: Column) -> Column:
    """Level codes of a type text such as ``Elementary/Middle``."""
    t = F.regexp_replace(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")), "prek", "pk")
    found = lambda v: [F.when(v.rlike(p), i) for i, p in enumerate(TYPE_LEVELS, 1)]
    return once(t, lambda v: span(F.coalesce(*found(v)), F.coalesce(*found(v)[::-1])))


def colon_grades(c: Column) -> Column:
    """``KG:01:02`` as ``k-2``; XG and empty parts are ignored, unknown grades sort last."""
    parts = F.filter(F.split(c, ":"), lambda g: (g != "") & (g != "XG"))
    named = F.transform(parts, lambda g: F.when(g.isin("P3", "PK"), "prek").when(g == "KG", "k").otherwise(F.coalesce(g.try_cast("int").cast("string"), g)))
    order = F.array(*map(F.lit, ["prek", "k", *map(str, range(1, 14))]))
    ranked = F.array_sort(F.transform(named, lambda g, i: F.struct(F.coalesce(F.nullif(F.array_position(order, g), F.lit(0)), F.lit(99)).alias("at"), i.alias("i"), g.alias("g"))))
    ends = lambda r: F.array_distinct(F.array(F.element_at(r, 1)["g"], F.element_at(r, -1)["g"]))
    several = lambda e: F.when(F.size(e) == 1, F.concat_ws("-", e[0], e[0])).otherwise(F.array_join(e, "-"))
    return once(ranked, lambda r: F.when(F.size(r) == 1, F.element_at(r, 1)["g"]).when(F.size(r) > 1, once(ends(r), several)))


def grade(c: Column) -> Column:
    text = F.lower(F.trim(c))
    named = lambda t: F.when(t.isin("pk", "pre-k", "pre k", "p0", "p3"), "prek").when(t.isin("kg", "k"), "k").when(t.rlike(r"^\d+$"), t.try_cast("int").cast("string")).otherwise(t)
    return once(text, lambda t: F.when(~t.isin("", "na", "n/a", "null", "ng", "ug"), named(t)))


def grade_span(low: Column, high: Column) -> Column:
    return F.concat(grade(low), F.lit("-"), grade(high))


def elementary_eligible(code: Column) -> Column:
    return code.isNull() | code.rlike("[ep]")
