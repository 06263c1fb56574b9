"""Mixing sources to target weights with exact word budgets, in DataFrame operations only.

Every row gets a hash-random key. Within a source the key space is cut into equal ranges, so that ordering by
range and then by key is a range sort of the source, and a large source spreads over many tasks. Prefix sums of
sizes run over the small table of ranges and, apart from that, inside each range. A source's budget is cut at the exact
word; budgets above the source's size run whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import saved, text_of

RANGE_ROWS = 4096  # rows that one range of a source should hold
CYCLE = (1, 2, 3)
MAX_EPOCHS = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame, cycle: tuple[int, ...] = CYCLE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, s, n, source_size, target) of a table (source, n, source_size) of one row per source.

    ``s`` numbers the sources by code point, null last; weights repeat ``cycle`` in that order. Targets share the
    total of all sizes by weight, none above ``max_epochs`` times its source; what is cut off is shared again
    by weight. That is a water level: sources ordered by cap per weight are full up to the first whose cap
    reaches the level which the rest of the total gives to the rest of the weights.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, cycle)), ((F.col("s") - 1) % len(cycle)).cast("int") + 1)
    table = sizes.withColumn("s", F.row_number().over(by_name)).withColumn("w", weight)
    table = table.withColumn("cap", max_epochs * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("w"))
    every = Window.partitionBy()
    before = Window.orderBy("ratio", "s").rowsBetween(Window.unboundedPreceding, -1)
    table = table.withColumn("rest", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    table = table.withColumn("weights", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    table = table.withColumn("level", F.col("rest") / F.col("weights"))
    reached = F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "s", "level"))
    table = table.withColumn("level", F.min(reached).over(every)["level"])
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("w"))
    return table.select("source", "s", "n", "source_size", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0, cycle: tuple[int, ...] = CYCLE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, start, epochs, part, taken, text_key (a hash of the text).

    ``size`` counts words (null text: 0). ``epochs`` whole copies of every row of the source are taken and ``part``
    words of the row in the last, unfinished epoch, in which the row starts ``start`` words after the source's
    first; ``taken`` = epochs * size + part. The taken words of a source add up to its rounded target. Keys depend on ``seed`` and
    the id, or the text where the id is null, so reruns agree; rows with equal ids are ordered by size and text. Null sources are an ordinary value.
    A source without words takes none; an empty table gives no rows. Other columns of ``docs`` are not read.
    """
    text = text_of(text_col)
    text_key = F.xxhash64(text, F.octet_length(text))
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("?"), text_key.cast("string")))
    key = F.conv(F.substring(F.md5(F.concat(name, F.lit(f"/{seed}"))), 1, 8), 16, 10).cast("long")
    rows = saved(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), word_count(text).alias("size"), key.alias("key"), text_key.alias("text_key")
    ))
    sizes = targets(rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size")), cycle, max_epochs)
    named = rows.alias("r").join(sizes.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select("r.*", "s", "n", "source_size", "target")
    ranges = F.ceil(F.col("n") / RANGE_ROWS)
    named = named.withColumn("range", F.floor(F.col("key") * ranges / (1 << 32)).cast("long"))
    before = Window.partitionBy("s").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = named.groupBy("s", "range").agg(F.sum("size").alias("sum")).select("s", "range", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("s", "range").orderBy("key", F.col("doc_id").asc_nulls_last(), "size", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    placed = named.join(offsets, ["s", "range"]).withColumn("start", F.col("offset") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as long) div source_size")).otherwise(0).cast("long")
    placed = placed.withColumn("epochs", epochs).withColumn("budget", budget - F.col("epochs") * F.col("source_size"))
    part = F.least(F.greatest(F.col("budget") - F.col("start"), F.lit(0)), F.col("size"))
    return placed.withColumn("part", part).withColumn("taken", F.col("epochs") * F.col("size") + F.col("part")).select(
        "doc_id", "source", "size", "source_size", "target", "start", "epochs", "part", "taken", "text_key"
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/0'), 1, 8) AS BIGINT) AS key
  FROM documents
), g AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS s FROM d GROUP BY source
), w AS (
  SELECT *, (s - 1) % 3 + 1 AS w, 3 * source_size AS cap, 3 * source_size / ((s - 1) % 3 + 1) AS ratio FROM g
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
  FROM w WINDOW b AS (ORDER BY ratio, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), (SELECT level FROM l WHERE level <= ratio ORDER BY ratio, s LIMIT 1) * w) AS target FROM l
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS LAST, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
         CASE WHEN t.source_size > 0 THEN round(t.target)::BIGINT // t.source_size ELSE 0 END AS epochs
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + least(greatest(round(target)::BIGINT - epochs * source_size - start, 0), size) AS BIGINT) AS taken
FROM p
"""
