"""Record linkage: exact, place and blocked fuzzy matches, ordered cascades, and collapsing of equal places."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity
from .places import shared_out
from .service import durable


class Matched(NamedTuple):
    matched: DataFrame
    left: DataFrame
    right: DataFrame


def first_per(df: DataFrame, keys: list[str], *order) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def filled(c: str) -> Column:
    return F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))


def sorted_in(df: DataFrame) -> DataFrame:
    """``df`` for a join that sorts it: rows that are few bytes in a shuffle may be too many for the driver to broadcast."""
    return df.hint("merge")


def split_off(matched: DataFrame, left: DataFrame, right: DataFrame, left_id: str, right_id: str) -> Matched:
    return Matched(
        matched, left.join(sorted_in(matched.select(F.col("orig_id_1").alias(left_id)).distinct()), left_id, "left_anti"),
        right.join(sorted_in(matched.select(F.col("orig_id_2").alias(right_id)).distinct()), right_id, "left_anti"),
    )


def by_key(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str) -> Matched:
    """Many to one on a key that is not blank; of several right rows with one key the smallest id counts."""
    keyed = lambda df, i, name: df.select(F.col(i).alias(name), filled(key).alias("k")).where("k is not null")
    one = first_per(keyed(right, right_id, "orig_id_2"), ["k"], "orig_id_2")
    matched = keyed(left, left_id, "orig_id_1").join(sorted_in(one), "k").select(
        "orig_id_1", "orig_id_2", F.lit(1.0).alias("match_score"), F.lit(f"Exact Match ({key})").alias("match_category"))
    return split_off(matched, left, right, left_id, right_id)


def exact(left: DataFrame, right: DataFrame, name: str, columns: list[str], left_id: str, right_id: str, require: str = "any") -> Matched:
    """Equal names and equal location columns, one to one.

    ``any``: the columns are tried in order and the first that agrees decides. ``all``: every column that the left row
    has must agree, and rows without any are left out. Each id is matched once, the smaller ids first.
    """
    l = left.select(F.col(left_id).alias("orig_id_1"), filled(name).alias("n"), *[filled(c).alias(f"l_{c}") for c in columns])  # noqa: E741
    r = right.select(F.col(right_id).alias("orig_id_2"), filled(name).alias("n"), *[filled(c).alias(f"r_{c}") for c in columns])
    # of the right rows that agree in a name and some columns only the smallest id counts, so no name's rows meet in pairs
    smallest = lambda cols: r.groupBy("n", *[f"r_{c}" for c in cols]).agg(F.min(F.struct("orig_id_2")).alias("one"))
    same = lambda cols: reduce(lambda x, y: x & y, [F.col(f"l_{c}") == F.col(f"r_{c}") for c in cols])
    hits = []
    if require == "any":
        tries = [([c], i, l.where(F.col(f"l_{c}").isNotNull())) for i, c in enumerate(columns)]
    else:
        has = F.concat_ws("", *[F.when(F.col(f"l_{c}").isNotNull(), "1").otherwise("0") for c in columns])
        marked = l.withColumn("has", has)
        patterns = sorted(x["has"] for x in marked.select("has").distinct().collect())  # at most two to the number of columns
        tries = [([c for c, bit in zip(columns, x) if bit == "1"], 0, marked.where(F.col("has") == x)) for x in patterns if "1" in x]
    for cols, turn, rows in tries:
        one = smallest(cols).withColumnRenamed("n", "r_n").where("r_n is not null")
        hits.append(rows.join(one, (F.col("n") == F.col("r_n")) & same(cols)).select("orig_id_1", F.lit(turn).alias("turn"), F.col("one.orig_id_2").alias("orig_id_2")))
    if not hits:
        hits = [l.where("false").select("orig_id_1", F.lit(0).alias("turn")).join(r.select("orig_id_2"))]
    pairs = reduce(DataFrame.union, hits).groupBy("orig_id_1").agg(F.min(F.struct("turn", "orig_id_2")).alias("b")).select("orig_id_1", "b.*")
    pairs = pairs.groupBy("orig_id_2").agg(F.min(F.struct("turn", "orig_id_1")).alias("b")).select("b.orig_id_1", "orig_id_2")
    return split_off(pairs.select("orig_id_1", "orig_id_2"), left, right, left_id, right_id)


def confirmed(pairs: DataFrame, every: DataFrame, within: Callable[[DataFrame], DataFrame], key: list[str], threshold_min: float, wide: float) -> DataFrame:
    """``pairs`` with ``low`` taken over all candidates in those few groups where the pairs at hand leave open whether any is near.

    These are groups whose nearest pair so far is farther than ``threshold_min``: a candidate that was left out for its bound may be nearer.
    """
    open_groups = pairs.where(F.col("low") > threshold_min).select(*key).distinct()
    same = reduce(lambda x, y: x & y, [every[c].eqNullSafe(open_groups[c]) for c in key])
    rest = every.where((F.col("least") > wide) & (F.col("least") <= threshold_min + similarity.SLACK)).join(sorted_in(open_groups), same, "left_semi")
    lower = within(rest).groupBy(*key).agg(F.min("jw").alias("__low"))
    lower = lower.select(*[F.col(c).alias(f"__{c}") for c in key], "__low")
    joined = pairs.join(sorted_in(lower), reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key]), "left")
    return joined.withColumn("low", F.least("low", "__low")).drop("__low", *[f"__{c}" for c in key])


def one_byte_off(asked: DataFrame, held: DataFrame, on: Column, key: list[str], exact_at: float) -> DataFrame:
    """(key, r_id, r_level, jw) of the nearest candidates of those rows of ``asked`` that surely have no nearer one, at most ``exact_at`` away.

    Names meet on their bytes without one, so the work follows the names and not the pairs of a block.
    """
    spelled = lambda df, p: df.withColumn(f"{p}_spelling", F.explode(similarity.spellings(f"{p}_name")))
    met = spelled(asked, "l").join(sorted_in(spelled(held, "r")), on & (F.col("l_spelling") == F.col("r_spelling"))).drop("l_spelling", "r_spelling").distinct()
    near = met.withColumn("jw", similarity.sounds("l_name", "r_name")["jw"]).withColumn("low", F.min("jw").over(Window.partitionBy(*key)))
    sure = (F.col("low") <= exact_at) & (F.col("low") + similarity.SLACK < similarity.least_unspelled(F.col("l_name")))
    return near.where(sure & (F.col("jw") == F.col("low"))).drop("low")


def fuzzy(left: DataFrame, right: DataFrame, name: str, block: list[str], left_id: str, right_id: str, threshold_min: float = 0.6,
          threshold: float = 0.6, exact_at: float = 0.05, keep: int = 10, level: str | None = None) -> Matched:
    """The best candidate of each left row within its block, by staged similarity.

    A single block column never matches null; of several, null matches null. Rows whose nearest candidate is a byte away, with no
    other as near, are settled by equal keys. For the rest, a bound of the distance from byte counts, lengths and first bytes drops most pairs of a block in the JVM; only the rest are compared in Python. Candidates at most ``exact_at`` away win
    outright. Else those within ``threshold``, or alike in sound and letters, are cut to the nearest ``keep``, graded by all
    measures, and the best grade wins, then the smallest distance, then the smaller id.
    """
    keys = [F.lower(F.col(c)) for c in block]
    side = lambda df, i, p: df.select(F.col(i).alias(f"{p}_id"), F.col(name).alias(f"{p}_name"), *([F.col(level).alias(f"{p}_level")] if level else []), *[k.alias(f"{p}{j}") for j, k in enumerate(keys)]).distinct()
    known = lambda p: f"{p}_name is not null" + (f" and {p}0 is not null" if len(block) == 1 else "")
    blocked = lambda df, p: df.withColumn("__block", F.struct(*[F.struct(F.col(f"{p}{j}").isNull().alias("n"), F.coalesce(f"{p}{j}", F.lit("")).alias("v")).alias(f"b{j}") for j in range(len(block))]))
    meeting = lambda one, other: one.join(sorted_in(other.select("__block").distinct()), "__block", "left_semi").drop("__block").checkpoint()
    durable(left.sparkSession)
    l, r = blocked(side(left, left_id, "l").where(known("l")), "l"), blocked(side(right, right_id, "r").where(known("r")), "r")  # noqa: E741
    l, r = meeting(l, r), meeting(r, l)  # noqa: E741 - rows whose block the other side has; the plan of the rest names them several times
    key = [c for c in l.columns if c != "l_id"]  # rows alike in all that is compared are scored once
    on = [F.col(f"l{j}") == F.col(f"r{j}") if len(block) == 1 else F.col(f"l{j}").eqNullSafe(F.col(f"r{j}")) for j in range(len(block))]
    met = reduce(lambda x, y: x & y, on)
    whole = l.select(*key).distinct()
    settled = one_byte_off(whole, r, met, key, exact_at).checkpoint()  # the plan of the rest names it several times
    nulls_too = lambda x, y: reduce(lambda p, q: p & q, [F.col(f"{x}.{c}").eqNullSafe(F.col(f"{y}.{c}")) for c in key])
    asked = whole.alias("w").join(sorted_in(settled.select(*key).distinct()).alias("s"), nulls_too("w", "s"), "left_anti").withColumn("l_sign", similarity.signs("l_name"))
    held = r.join(sorted_in(r.select("r_name").distinct().withColumn("r_sign", similarity.signs("r_name"))), "r_name")
    every = shared_out(blocked(asked, "l"), blocked(held, "r"), "__block").drop("__block").withColumn("least", similarity.least_distance(F.col("l_sign"), F.col("r_sign")))
    # a candidate is taken for a distance within the larger bound, or for its sound below 0.5; others matter at most for whether any is near
    wide, sound = max(exact_at, min(0.5, threshold)) + similarity.SLACK, (F.col("l_sign.soundex") == F.col("r_sign.soundex")) & (F.col("least") < 0.5)
    within = lambda rows: rows.drop("l_sign", "r_sign", "least").withColumn("e", similarity.sounds("l_name", "r_name")).withColumn("jw", F.col("e.jw")).where((F.col("jw") < 0.5) | (F.col("jw") <= exact_at))
    a, b = F.col("l_name"), F.col("r_name")
    pairs = within(every.where((F.col("least") <= wide) | sound)).checkpoint().withColumn("low", F.min("jw").over(Window.partitionBy(*key)))
    if threshold_min > wide - similarity.SLACK:
        pairs = confirmed(pairs, every, within, key, threshold_min, wide)
    pairs = pairs.where(F.col("low") <= threshold_min)
    near = (F.col("low") <= exact_at) & (F.col("jw") <= exact_at)
    alike = F.when(F.col("e.soundex") == 0, similarity.cosine(a, b)) <= 0.25
    pairs = pairs.where(near | ((F.col("low") > exact_at) & ((F.col("jw") <= threshold) | F.coalesce(alike, F.lit(False)))))
    order = Window.partitionBy(*key).orderBy("jw", "r_id")
    pairs = pairs.withColumn("__n", F.row_number().over(order)).where((F.col("__n") <= keep) | (F.col("low") <= exact_at))
    pairs = pairs.withColumn("cos", similarity.cosine(a, b)).withColumn("jac", similarity.jaccard(a, b)).withColumn("osa", similarity.edits(a, b)["osa"])
    sound, edit = F.col("e.soundex") == 0, F.col("osa") / F.greatest(F.char_length(b), F.lit(1))
    first = ((F.col("jac") <= 0.05) & (F.col("cos") <= 0.05)) | (F.col("jw") <= 0.15) | (sound & (F.col("jw") <= 0.3))
    second = (sound & (F.col("cos") <= 0.25)) | ((F.col("jac") <= 0.15) & (F.col("cos") <= 0.15) & (edit <= 0.4)) | (F.col("jw") <= 0.21)
    grade = F.when(F.col("low") <= exact_at, 0).when((F.col("jw") < 0.5) & (F.col("jac") < 0.5), F.when(first, 1).when(second, 2))
    other_level = F.when(F.col("l_level").isNull() | (F.col("l_level") == F.col("r_level")), 0).otherwise(1) if level else F.lit(0)
    graded = lambda rows, grade: rows.withColumn("grade", grade).where("grade is not null").withColumn("other", other_level).select(*key, "r_id", "jw", "grade", "other")
    best = first_per(graded(pairs, grade).union(graded(settled, F.lit(0))), key, "grade", "jw", F.when(F.col("grade") == 0, F.col("other")), "r_id")
    category = F.when(F.col("jw") <= exact_at, "Exact Match").when(F.col("jw") <= 2 * exact_at, "High").when(F.col("jw") <= 5 * exact_at, "Moderate").otherwise("Low")
    best = l.alias("l").join(sorted_in(best).alias("b"), nulls_too("l", "b"))
    matched = best.select(F.col("l_id").alias("orig_id_1"), F.col("r_id").alias("orig_id_2"), (1 - F.col("jw")).alias("match_score"), category.alias("match_category"))
    return split_off(matched, left, right, left_id, right_id)


class Pass(NamedTuple):
    """One step of a cascade: a matcher (left, right) -> Matched, an optional condition on the whole inputs, and row filters."""

    name: str
    match: Callable[[DataFrame, DataFrame], Matched]
    condition: Callable[[DataFrame, DataFrame], bool] | None = None
    left_filter: Column | None = None
    right_filter: Column | None = None


def cascade(left: DataFrame, right: DataFrame, passes: list[Pass], left_id: str, right_id: str) -> Matched:
    """Passes in order; each sees the left rows that none before matched, and the whole right side.

    Every pass is checkpointed, because the next anti-joins it.
    """
    rest, found = left, None
    for step in passes:
        if step.condition is not None and not step.condition(left, right):
            continue
        l = rest if step.left_filter is None else rest.where(step.left_filter)  # noqa: E741
        r = right if step.right_filter is None else right.where(step.right_filter)
        hits = step.match(l, r).matched.select("orig_id_1", "orig_id_2", F.lit(step.name).alias("pass")).checkpoint()
        found = hits if found is None else found.union(hits)
        rest = left.join(sorted_in(found.select(F.col("orig_id_1").alias(left_id)).distinct()), left_id, "left_anti")  # not on the rest before, so that plans stay small
    if found is None:
        found = left.sparkSession.createDataFrame([], "orig_id_1 long, orig_id_2 long, pass string")
    return split_off(found, left, right, left_id, right_id)


LEVEL_BITS = {"p": 1, "e": 2, "m": 4, "h": 8}


def level_mask(codes: Column) -> Column:
    return reduce(lambda x, y: x + y, [F.when(F.coalesce(codes, F.lit("")).contains(k), bit).otherwise(0) for k, bit in LEVEL_BITS.items()])


def collapse_places(df: DataFrame, id_col: str, place_col: str = "place_id", level_col: str = "level_code") -> DataFrame:
    """Adds ``new_id``: rows of one place whose levels meet, directly or through others, become the one with the smallest id.

    Rows without a place stay alone; a row without levels meets all of its place. With four levels a place has at most
    fifteen different masks, so its groups come from an aggregate over distinct masks.
    """
    rows = df.withColumn("__place", filled(place_col)).withColumn("__mask", level_mask(F.col(level_col)))
    masks = rows.where("__place is not null").groupBy("__place").agg(F.collect_set("__mask").alias("all"))
    grown = lambda m, every: F.aggregate(every, m, lambda a, x: F.when((a.bitwiseAND(x) != 0) | (x == 0) | (a == 0), a.bitwiseOR(x)).otherwise(a))
    closed = masks.select("__place", F.explode("all").alias("__mask"), "all")
    closed = closed.withColumn("group", F.when(F.array_contains("all", 0), F.lit(0)).otherwise(grown(grown(grown(F.col("__mask"), F.col("all")), F.col("all")), F.col("all"))))
    joined = rows.join(closed.drop("all"), ["__place", "__mask"], "left")
    key = [F.coalesce("__place", F.concat(F.lit("\0"), F.col(id_col).cast("string"))), F.coalesce("group", F.lit(-1))]
    return joined.withColumn("new_id", F.min(id_col).over(Window.partitionBy(*key))).drop("__place", "__mask", "group")
