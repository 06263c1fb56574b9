"""Names of places in one spelling, and the names of a list that a place may be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .address import folded
from .similarity import SLACK, edits, least_distance, likeness, signs
from .text import blank_to_null


def plain_string(c: Column) -> Column:
    """Latin letters without accents, lower case, without blanks and punctuation; the parts between ``|`` as an array."""
    part = lambda x: F.regexp_replace(F.lower(folded(x)), r"[ \p{Punct}]", "")
    return F.transform(F.split(c, r"\|"), part)


def plain_location(c: Column) -> Column:
    """A name of places from large to small, ``a::b::c``: each in plain letters, ``|`` and ``-`` kept, empty or NA ends cut off."""
    marked = F.replace(F.replace(F.replace(c, F.lit("|"), F.lit("vertcharacter")), F.lit("-"), F.lit("dashcharacter")), F.lit("::"), F.lit("doublecoloncharacter"))
    text = F.array_join(plain_string(marked), "")
    text = F.replace(F.replace(F.replace(text, F.lit("doublecoloncharacter"), F.lit("::")), F.lit("dashcharacter"), F.lit("-")), F.lit("vertcharacter"), F.lit("|"))
    return F.regexp_replace(F.regexp_replace(text, r":{3,}", "::"), r"(::(na)?)+$", "")


def first_name(packed: Column, standard: Column, separator: str = "; ") -> Column:
    """The name to look a school up by: the first of its original names, else the standard one."""
    return F.coalesce(blank_to_null(F.substring_index(packed, separator, 1)), standard)


CLOSE, NEAR = 0.1, 0.31  # Jaro-Winkler distances of close names, and of those that are listed
EQUAL_HEAD = 8  # hex digits of the first bytes that raise a similarity most
LEAST_COMMON = 0.5714  # share of either name's bytes in common at a distance of ``CLOSE`` where those first bytes differ: 3 (1 - 0.1 / 0.7) - 2


def _digits(c: Column) -> Column:
    return F.hex(F.encode(c, "UTF-8"))


def _shorter(c: Column) -> Column:
    """A name and all that remain of it without one byte, as hex digits."""
    h = _digits(c)
    cut = F.transform(F.sequence(F.lit(0), F.greatest(F.octet_length(c) - 1, F.lit(0))), lambda i: F.concat(F.substr(h, F.lit(1), 2 * i), F.substr(h, 2 * i + 3)))
    return F.array_distinct(F.array_append(cut, h))


def _letters(rows: DataFrame, column: str) -> DataFrame:
    """(column, size, token) of a table of distinct names: its bytes, each with its occurrence."""
    parts = F.regexp_extract_all(_digits(F.col(column)), F.lit("(..)"), 1)
    counted = lambda p: F.transform(p, lambda x, i: F.concat(x, F.size(F.filter(F.slice(p, F.lit(1), i + 1), lambda y: y == x)).cast("string")))
    return rows.select(column, F.octet_length(column).alias("size"), F.explode(F.transform(F.array(parts), counted)[0]).alias("token"))


def _ranked(letters: DataFrame, column: str, counts: DataFrame) -> DataFrame:
    """Adds ``place``: the tokens of a name counted from the rarest of the list's."""
    order = Window.partitionBy(column).orderBy(F.coalesce("held", F.lit(0)), "token")
    return letters.join(counts, "token", "left").withColumn("place", F.row_number().over(order)).drop("held")


def _apart(x: Column, y: Column) -> Column:
    """At least so many bytes stand in one name only, by their signatures."""
    shared = F.bit_count(x["low"].bitwiseAND(y["low"])) + F.bit_count(x["high"].bitwiseAND(y["high"])) + F.least(x["more"], y["more"])
    return x["size"] + y["size"] - 2 * F.least(shared, x["size"], y["size"])


def match_locations(asked: DataFrame, listed: DataFrame, name: str = "name", standardized: bool = False) -> DataFrame:
    """(name, matched, score_sum) for each distinct name that is not null, null where the list (column ``name``) holds nothing like it.

    If any entry is at most one edit away, or else at most 0.1 in Jaro-Winkler distance, the smallest sum of all measures wins
    (ties to the first name). Else all entries within three edits, 0.31 and the same sound are listed together.

    Entries are found by keys, so the work grows with the names that share one and not with names times entries. One edit: names meet on
    what is left without one byte. 0.1: on their first four bytes, or on one of the rarest bytes of both, as they have most bytes
    in common. The same sound: on the code. A name with a close entry then asks once more for every entry that its sum does not rule out:
    the sum is at least one and a half times the bytes that stand in one of both only, so those names share one of the name's
    rarest bytes; the number to look at follows from the sum. Signatures drop most pairs before their letters are compared.
    """
    plain = (lambda c: c) if standardized else plain_location
    names = asked.select(F.col(name).alias("name")).where("name is not null").distinct().withColumn("a", plain(F.col("name")))
    entries = listed.select(F.col(name).alias("entry")).where("entry is not null").distinct().withColumn("b", plain(F.col("entry")))
    a = names.select("a").distinct().withColumn("x", signs("a"))
    b = entries.select("b").distinct().withColumn("y", signs("b"))
    letters = _letters(b, "b")
    counts = letters.groupBy("token").agg(F.count("*").alias("held"))
    first, second = _ranked(_letters(a, "a"), "a", counts), _ranked(letters, "b", counts)
    x, y = F.col("x"), F.col("y")

    head = lambda c: F.when(F.octet_length(c) >= EQUAL_HEAD // 2, F.left(_digits(F.col(c)), F.lit(EQUAL_HEAD)))
    few = F.col("place") <= F.col("size") - F.ceil(F.col("size") * LEAST_COMMON) + 1

    def keys(rows: DataFrame, tokens: DataFrame, c: str, sign: str) -> DataFrame:
        own = rows.select(c, F.array(F.concat(F.lit("h"), head(c)), F.concat(F.lit("s"), F.nullif(F.col(f"{sign}.soundex"), F.lit("")))).alias("own"), F.transform(_shorter(F.col(c)), lambda v: F.concat(F.lit("d"), v)).alias("cut"))
        fixed = own.select(c, F.explode(F.concat("own", "cut")).alias("key")).where("key is not null")
        return fixed.union(tokens.where(few).select(c, F.concat(F.lit("t"), "token")))

    met = keys(a, first, "a", "x").join(keys(b, second, "b", "y"), "key").select("a", "b").distinct()
    signed = met.join(a, "a").join(b, "b")
    least, apart = least_distance(x, y), _apart(x, y)
    same = (F.col("x.soundex") == F.col("y.soundex")) & (F.col("x.soundex") != "")
    maybe = signed.where((apart <= 2) | (least <= CLOSE + SLACK) | (same & (apart <= 6) & (least <= NEAR + SLACK))).select("a", "b")
    measured = maybe.withColumn("e", edits("a", "b"))
    close = (F.col("e.osa") <= 1) | (F.col("e.jw") <= CLOSE)
    alike = (F.col("e.osa") <= 3) & (F.col("e.jw") <= NEAR) & (F.col("e.soundex") == 0)
    near = measured.where(close | alike).select("a", "b", close.alias("close"), alike.alias("alike"))
    near = near.withColumn("score", likeness(F.col("a"), F.col("b"))["score_sums"]).checkpoint()

    # names with a close entry: no better entry has more than ``most`` bytes that the name has not, or the other way round
    sought = near.groupBy("a").agg(F.min(F.when(F.col("close"), F.col("score"))).alias("limit")).where("limit is not null")
    sought = sought.withColumn("most", F.floor((F.col("limit") + SLACK) / 1.5))
    shared = first.join(sought, "a").where(F.col("place") <= F.col("most") + 1).select("a", "token", "most").join(second.select("b", "token", F.col("place").alias("other")), "token")
    shared = shared.where(F.col("other") <= F.col("most") + 1).select("a", "b")
    short = sought.withColumn("room", F.col("most") - F.octet_length("a")).where("room >= 0").select("a", F.explode(F.sequence(F.lit(0).cast("long"), "room")).alias("size"))
    nothing = short.join(b.select("b", F.octet_length("b").cast("long").alias("size")), "size").select("a", "b")  # these may have no byte in common
    more = shared.union(nothing).distinct().join(near.select("a", "b"), ["a", "b"], "left_anti").join(a, "a").join(b, "b").join(sought, "a")
    bound = F.greatest(F.ceil(apart / 2), F.abs(F.col("x.size") - F.col("y.size"))) + apart + least + F.when(same, 0).otherwise(1)
    more = more.where(bound <= F.col("limit") + SLACK).select("a", "b").withColumn("score", likeness(F.col("a"), F.col("b"))["score_sums"])

    scored = near.join(sought.select(F.col("a").alias("__a")), F.col("a") == F.col("__a"), "left").withColumn("best", F.col("__a").isNotNull())
    scored = scored.where("best or alike").select("a", "b", "score", "best").union(more.select("a", "b", "score", F.lit(True)))
    hits = names.join(scored, "a").join(entries, "b")
    order = Window.partitionBy("name").orderBy("score", "entry")
    hits = hits.withColumn("n", F.row_number().over(order)).where("not best or n = 1")
    found = hits.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("entry", "score"))).alias("l"))
    text = lambda field: F.array_join(F.transform("l", lambda v: v[field].cast("string")), ", ")
    return names.select("name").join(found.select("name", text("entry").alias("matched"), text("score").alias("score_sum")), "name", "left")
