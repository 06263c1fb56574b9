"""Quality rules as a short-circuit cascade, in DataFrame operations only.

Each rule is a boolean column that rejects. On a bounded sample every rule's cost (seconds) and share of rejected
rows are measured; rules then run in the order of rejection per cost, and a row stops at the first that rejects it.
The order decides how much is computed and which rule is named first, never what is kept.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce
from statistics import median

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import saved, text_of

SAMPLE_ROWS = 2000
REPEAT, RUNS = 4, 3
LEAST = 1e-4  # seconds; less cannot be told from none
FEW = 24  # repeated windows of a text that are looked up one by one
BLANKS = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"


def share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def words_of(text: Column) -> Column:
    """The words of a text, as an array."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, GAP))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.transform(F.array(value), then)[0]


def repeat_words(words: Column, window: int = 3) -> Column:
    """Number of words inside windows that occur more than once, first occurrences included.

    Windows are hashed (64 bits), sorted with their places, and the places of equal neighbours merged as intervals.
    """
    n = F.size(words)
    at = F.sequence(F.lit(0), n - window)
    hashes = F.transform(at, lambda i: F.xxhash64(*[words[i + k] for k in range(window)]))

    def covered(places: Column) -> Column:
        step = lambda x, k: F.least(F.lit(window), F.when(k == 0, F.lit(window)).otherwise(x - places[k - 1]))
        return F.aggregate(F.transform(places, step), F.lit(0), lambda a, x: a + x)

    def by_sort(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = lambda s: F.filter(s, lambda x, k: ((k > 0) & (s[F.greatest(k - 1, F.lit(0))]["h"] == x["h"])) | ((k < F.size(s) - 1) & (s[F.least(k + 1, F.size(s) - 1)]["h"] == x["h"])))
        return F.array_sort(F.transform(let(ordered, same), lambda x: x["i"]))

    def repeated(h: Column) -> Column:
        twice = let(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, k: (k > 0) & (s[F.greatest(k - 1, F.lit(0))] == x))))
        # the same places either way: a few repeated values are looked up, many are sorted out
        places = let(twice, lambda d: F.when(F.size(d) <= FEW, F.filter(at, lambda i: F.array_contains(d, h[i]))).otherwise(by_sort(h)))
        return let(places, covered)

    count = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(repeated(h)))
    return F.when(n < window, F.lit(0)).otherwise(count).cast("long")


def base_metrics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed to each row; null text has no words."""
    text = text_of(text_col)
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    found = docs.withColumn("__words", words_of(text)).withColumn("__lines", lines)
    found = found.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": repeat_words(F.col("__words")),
    })
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.withColumn("base_failed", failed).drop("__words", "__lines")


def default_rules(text_col: str = "text", n_words: str | None = None, n_symbols: str | None = None) -> dict[str, Column]:
    """Rejecting conditions on the raw text, or on counts that are columns already; null text is empty and passes all of them."""
    text = text_of(text_col)
    n = F.col(n_words) if n_words else F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    symbols = F.col(n_symbols) if n_symbols else F.regexp_count(text, F.lit(r"[#*$%&|<>]"))
    letters = F.regexp_count(text, F.lit(r"\p{L}"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return {
        "symbols": share(symbols, n) > 0.5,
        "shouting": share(F.regexp_count(text, F.lit(r"\p{Lu}")), letters) > 0.5,
        "letters": (F.length(text) > 0) & (share(letters, F.length(text)) < 0.4),
        "word_length": (n > 0) & ~share(F.length(text), n).between(2.5, 30),
        "lists": share(F.regexp_count(text, F.lit(r"[\x20\n]\|[\x20\n]")), n) > 0.25,
        "same_lines": (F.size(lines) > 3) & (share(F.size(F.array_distinct(lines)), F.size(lines)) < 0.5),
    }


def plan(docs: DataFrame, rules: dict[str, Column], id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Rules in cascade order with the measured ``cost`` (seconds) and ``rejection`` on the sample.

    The sample holds about ``sample_rows`` rows chosen by a hash of the id (all rows of a smaller table). Costs are medians of
    ``RUNS`` runs over ``REPEAT`` copies of it. The next rule is always the one that rejects most per cost of the rows that
    the rules before it leave, and ``rejection`` is its share of those. Rejections come from counts of rule combinations.
    """
    total = docs.count()
    spread = max(1, total // sample_rows)
    sample = saved(docs.where(F.pmod(F.xxhash64(F.col(id_col), F.lit("cascade")), F.lit(spread)) == 0))
    flags = sample.select(*[F.coalesce(c, F.lit(False)).alias(k) for k, c in rules.items()])
    combinations = flags.groupBy(*rules).agg(F.count("*").alias("__n")).collect()  # as many rows as rules can fail together
    copies = reduce(DataFrame.union, [sample] * REPEAT)

    def seconds(c: Column) -> float:
        runs = []
        for _ in range(RUNS):
            began = time.perf_counter()
            copies.select(c).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        return median(runs)

    floor = seconds(F.length(F.col(docs.columns[0]).cast("string")))
    cost = {k: max((seconds(c) - floor) / REPEAT, LEAST) for k, c in rules.items()}
    table, left = [], list(rules)
    while left:
        reach = [r for r in combinations if not any(r[t["rule"]] for t in table)]
        hits = {k: sum(r["__n"] for r in reach if r[k]) for k in left}
        best = min(left, key=lambda k: (-hits[k] / cost[k], cost[k], k))
        table.append({"rule": best, "cost": cost[best], "rejection": hits[best] / max(1, sum(r["__n"] for r in reach))})
        left.remove(best)
    return table


def cascade(docs: DataFrame, rules: dict[str, Column], id_col: str = "doc_id", order: list[str] | None = None) -> DataFrame:
    """Adds ``rejected_by`` (the first rule that rejects the row, null if none) and ``kept`` to every row.

    A rule that gives null does not reject. Rows with null ids or texts and repeated rows are ordinary rows; an empty
    table stays empty. The two added columns replace any of these names.
    """
    order = order or [r["rule"] for r in plan(docs, rules, id_col)]
    first = F.lit(None).cast("string")
    for name in reversed(order):
        first = F.when(rules[name], F.lit(name)).otherwise(first)
    return docs.withColumn("rejected_by", first).withColumn("kept", F.col("rejected_by").isNull())


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), g AS (
  SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) > 2
), k AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS n FROM g
), c AS (
  SELECT r, count(DISTINCT j) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM k WHERE n > 1) GROUP BY r
), m AS (
  SELECT doc_id, t, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines,
         length(regexp_replace(t, '\P{L}', '', 'g')) AS letters, length(regexp_replace(t, '\P{Lu}', '', 'g')) AS capitals, len(regexp_extract_all(t, '[\x20\n]\|[\x20\n]')) AS bars
  FROM w LEFT JOIN c USING (r)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (
  base_failed OR coalesce(n_symbols / nullif(n_words, 0), 0) > 0.5 OR coalesce(capitals / nullif(letters, 0), 0) > 0.5 OR (length(t) > 0 AND letters / length(t) < 0.4)
  OR (n_words > 0 AND (length(t) / n_words < 2.5 OR length(t) / n_words > 30)) OR coalesce(bars / nullif(n_words, 0), 0) > 0.25
  OR (n_lines > 3 AND (n_lines - n_dup_lines) / n_lines < 0.5)
) AS kept FROM b
"""
