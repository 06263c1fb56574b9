"""Names and categories as ordered rewrite rules over column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and replacements of the roster vocabulary, in the order in which they apply.
INITIAL_DOTS = (r"(?<=\b[a-z])\.(?=[a-z]\b)", "")
SCHOOL_NAME = [
    (r"[&]", "and"),
    INITIAL_DOTS,
    (r"\b([kp]?\d?)\s*[-–]\s*(\d+)\b", "$1-$2"),
    (r"\be\.?s\.?\b", "elementary"),
    (r"\b(elm|elem|elemntary|elemantary|elemenatry|elementery|elementry|elememtary|elemen)\b", "elementary"),
    (r"\b(sdchool|skool|schoool|schools|scholl|schol)\b", "school"),
    (r"\bdev\b", "development"),
    (r"[/.-]", " "),
    (r"\p{P}", ""),
    (r"\bschool\b", ""),
    (r"^the\s+", ""),
]
COUNTY_NAME = [INITIAL_DOTS, (r"county", ""), (r"[/.-]", " "), (r"\p{P}", "")]
DISTRICT_NAME = [
    INITIAL_DOTS, (r"school district", ""), (r"\bunified\b", ""), (r"\bindependent\b", ""), (r"\bpublic schools\b", ""),
    (r"\bcity schools\b", ""), (r"&amp;|&", "and"), (r"[/.-]", " "), (r"\p{P}", ""),
]
LEVELS = [
    ((r"\bkindergar\b|\bkindergarten\b", r"\bpre and lower\b|\bpre and elem\b|\bnursery\b"), "PreK/Elementary"),
    ((r"elementary/middle|elem/middle|elementary and middle|elementary middle",), "Elementary/Middle"),
    ((r"middle/high|middle and high|middle high|middlehigh",), "Middle/High"),
    ((r"\bmiddle\b", r"\bhigh\b"), "Middle/High"),
    ((r"\bpre[- ]?k\b|\bprek\b|\bpreschool\b|\bnursery\b",), "PreK"),
    ((r"\bkindergar\b|\bkindergarten\b",), "Elementary"),
    ((r"\belementary\b|\blower\b|\bprimary\b|\belementary school\b",), "Elementary"),
    ((r"\bmiddle( school)?\b",), "Middle"),
    ((r"\b(high school|senior high( school)?)\b|\bhigh\b(?!\s*road\b)|\bhs\b|\bhigh\s*$",), "High"),
]
LEVEL_WORDS = [
    (r"middle/high|middle and high|middle high|middlehigh", ""),
    (r"elementary/middle|elem/middle|elementary and middle|elementary middle", ""),
    (r"\belementary school\b", ""),
    (r"\bmiddle school\b", ""),
    (r"\bhigh school\b|\bhs\b|\bsenior high( school)?\b", ""),
    (r"\belementary\b|\blower\b|\bprimary\b|\bmiddle\b", ""),
    (r"\bhigh\b\s*$", ""),
    (r"elemntary|elemantary|elemenatry|elementery|elementry|elememtary|elemen", ""),
    (r"sdchool|skool|schoool|schools", ""),
]
TYPES = [
    ((r"charter",), "charter"), ((r"non[- ]?public|oosle|private|independent|religious",), "private"), ((r"\bpublic\b|\blea\b|special",), "public"),
]
PO_BOX = r"(?i)\bP\.?\s*O\.?\s*BOX\b|\bPOBOX\b|\bPOST\s+OFFICE\s+BOX\b"


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that a row computes once, however often ``f`` names it."""
    return F.transform(F.array(c), f)[0]


def squish(c: Column) -> Column:
    """Inner white space to one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def rewritten(c: Column, rules) -> Column:
    return reduce(lambda x, rule: F.regexp_replace(x, *rule), rules, c)


def school_name(c: Column) -> Column:
    return F.regexp_replace(squish(rewritten(F.lower(squish(c)), SCHOOL_NAME)), r"\bmount\b", "mt")


def county_name(c: Column) -> Column:
    return squish(rewritten(F.lower(squish(c)), COUNTY_NAME))


def district_name(c: Column) -> Column:
    return squish(rewritten(F.lower(squish(c)), DISTRICT_NAME))


def first_match(c: Column, rules, flags: str = "(?i)") -> Column:
    """The label of the first rule whose patterns are all found, else null."""
    fits = lambda v, patterns: reduce(lambda x, y: x & y, [v.rlike(flags + p) for p in patterns])
    return once(c, lambda v: F.coalesce(*[F.when(fits(v, patterns), F.lit(label)) for patterns, label in rules]))


def school_level(c: Column) -> Column:
    return first_match(squish(c), LEVELS)


def without_level(c: Column) -> Column:
    """A name without its level words."""
    return squish(rewritten(F.lower(squish(c)), LEVEL_WORDS))


def school_type(c: Column) -> Column:
    return first_match(F.nullif(F.lower(F.trim(c)), F.lit("")), TYPES)


def is_po_box(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(PO_BOX)


def has_street_address(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^\d"), F.lit(False))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def year_label(filename: Column, state: str) -> Column:
    """``st_yy_yy`` of a file name with 20YY-20YY, else ``st_unknown_`` and the stem."""
    name = F.regexp_replace(F.substring_index(filename, "/", -1), r"\.[^.]*$", "")
    found = F.regexp_extract(name, r"20(\d{2})-20(\d{2})", 1)
    label = F.concat(F.lit(f"{state}_"), found, F.lit("_"), F.regexp_extract(name, r"20(\d{2})-20(\d{2})", 2))
    return F.when(found != "", label).otherwise(F.concat(F.lit(f"{state}_unknown_"), name))


def first_number(c: Column) -> Column:
    """The first number in a text as a double, thousands separators dropped."""
    return F.nullif(F.regexp_extract(F.regexp_replace(c, ",", ""), r"-?\d+\.?\d*", 0), F.lit("")).try_cast("double")
