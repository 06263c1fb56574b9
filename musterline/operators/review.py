"""Why schools stay unmatched: the nearest school by name in every reference, and an explanation from all of them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity
from ..functions.numeric import haversine_m
from ..functions.text import school_name, without_level
from .places import MOST_TASKS, in_cells, met_keys, within
from .service import durable

# Columns of a candidate, and the explanations in the order in which they hold.
CANDIDATE = ("name", "matched_name", "city", "status", "detail", "sim", "dist_m")
CLOSED = "closed school: matches a closed NCES school nearby"
RENAMED = "renamed school: matches an open NCES school by its former name"
VARIANT = "open school in a reference source under a similar name (name mismatch)"
POSSIBLE = "possible name match (lower similarity): check"
STOPPED = "no similar reference school; stopped reporting before the latest years, probably closed"
REPORTING = "no similar reference school; still reporting: check"


def finite_median(c: str) -> Column:
    """The median of the finite values; null without any."""
    x = F.col(c).cast("double")
    return F.median(F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x))


def unmatched(joined: DataFrame) -> DataFrame:
    """One row per name and county of the records without a school: standard name, years, and the median of their points."""
    for c in ("lat", "lon"):
        joined = joined if c in joined.columns else joined.withColumn(c, F.lit(None).cast("double"))
    rows = joined.where("school_id is null").withColumn("year", F.substring("year_source", 1, 4).try_cast("int"))
    return rows.groupBy("school_name", "county_std").agg(
        F.min("school_name_std_vacc").alias("school_name_std"), F.min("year").alias("first_year"), F.max("year").alias("last_year"),
        F.countDistinct(F.coalesce("year", F.lit(-1))).alias("n_years"), finite_median("lat").alias("lat"), finite_median("lon").alias("lon"))


def reference(df: DataFrame) -> DataFrame:
    """A roster as a reference of the review; it needs school_name, school_name_std and county_std."""
    missing = [c for c in ("school_name", "school_name_std", "county_std") if c not in df.columns]
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    status = next((c for c in ("current_status", "business_status") if c in df.columns), None)
    text = lambda c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
    number = lambda c: F.col(c).try_cast("double") if c in df.columns else F.lit(None).cast("double")
    return df.select(
        F.col("school_name").alias("ref_name"), F.col("school_name").alias("ref_variant"), text("city").alias("ref_city"), (F.upper(F.col(status).cast("string")) if status else F.lit(None).cast("string")).alias("ref_status"),
        text("school_type").alias("ref_detail"), F.col("school_name_std").alias("ref_std"), F.col("county_std").alias("ref_county"), number("lat").alias("r_lat"), number("lon").alias("r_lon"))


def directory_reference(df: DataFrame, standard: Callable[[Column], Column] = lambda c: without_level(school_name(c))) -> DataFrame:
    """A school directory (nces_name, names: array, business_status, last_seen, lat, lon) with a row for each former name."""
    rows = df.select("*", F.explode(F.coalesce("names", F.array("nces_name"))).alias("ref_variant"))
    return rows.select(
        F.col("nces_name").alias("ref_name"), "ref_variant", F.lit(None).cast("string").alias("ref_city"), F.upper("business_status").alias("ref_status"),
        F.concat(F.lit("last seen "), F.col("last_seen").cast("string")).alias("ref_detail"), standard(F.col("ref_variant")).alias("ref_std"), F.lit(None).cast("string").alias("ref_county"),
        F.col("lat").cast("double").alias("r_lat"), F.col("lon").cast("double").alias("r_lon"))


def known(left: DataFrame, found: DataFrame, key: list[str], how: str = "inner") -> DataFrame:
    """``left`` with the other columns of ``found``, which has one row or none per ``key``; nulls are equal."""
    found = found.withColumnsRenamed({c: f"__{c}" for c in key})
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key])
    return left.join(found, same, how).drop(*[f"__{c}" for c in key])


def nearest_names(left: DataFrame, key: list[str], pairs_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Of the pairs of ``pairs_of(left)`` those that may have the smallest Jaro-Winkler distance ``jw`` of their ``key``.

    Pairs are made three times and never moved or sorted: for the smallest bound of a key, for the distance of the pairs with that
    bound, and for the pairs whose bound is not above that distance.
    """
    bound = similarity.least_distance(F.col("l_sign"), F.col("r_sign"))
    compared = lambda pairs: pairs.drop("l_sign", "r_sign").withColumn("jw", similarity.sounds("school_name_std", "ref_std")["jw"])
    low = known(left, pairs_of(left).groupBy(*key).agg(F.min(bound).alias("low")), key).checkpoint()
    top = known(low, compared(pairs_of(low).where(bound <= F.col("low"))).groupBy(*key).agg(F.min("jw").alias("top")), key).checkpoint()
    return compared(pairs_of(top).where(bound <= F.col("top") + similarity.SLACK)).drop("low", "top")


def best_in_county(left: DataFrame, ref: DataFrame) -> DataFrame:
    """Pairs of the most similar names in the same county; a name and county are compared once, however many rows have them."""
    named = left.select("school_name_std", "county_std").distinct()
    listed = ref.select("ref_std", "ref_county").distinct()
    same = named["county_std"].eqNullSafe(listed["ref_county"])
    equal = named.join(listed, same & (F.col("school_name_std") == F.col("ref_std"))).select("school_name_std", "county_std", "ref_std", F.lit(0.0).alias("jw"))
    rest = named.join(listed, same & (F.col("school_name_std") == F.col("ref_std")), "left_anti").withColumn("l_sign", similarity.signs("school_name_std")).checkpoint()
    signed = listed.withColumn("r_sign", similarity.signs("ref_std")).checkpoint()
    pairs_of = lambda some: some.join(signed, F.col("county_std").eqNullSafe(F.col("ref_county"))).drop("ref_county")
    pairs = nearest_names(rest, ["school_name_std", "county_std"], pairs_of)
    first = pairs.groupBy("school_name_std", "county_std").agg(F.min("jw").alias("__jw"))
    pairs = known(pairs, first, ["school_name_std", "county_std"]).where(F.col("jw") == F.col("__jw")).select(*equal.columns).union(equal)
    pairs = pairs.withColumnsRenamed({"school_name_std": "__name", "county_std": "__county", "ref_std": "__ref"})
    rows = left.join(pairs, (F.col("school_name_std") == F.col("__name")) & F.col("county_std").eqNullSafe(F.col("__county")))
    rows = rows.join(ref, (F.col("__ref") == F.col("ref_std")) & F.col("__county").eqNullSafe(F.col("ref_county")))
    return rows.withColumn("distance_m", haversine_m(F.col("l_lat"), F.col("l_lon"), F.col("r_lat"), F.col("r_lon")))


RINGS = (16, 4, 1)  # parts of the distance within which an equal name is looked for, in turn


def best_nearby(left: DataFrame, ref: DataFrame, metres: float) -> DataFrame:
    """Pairs of the most similar names within a distance, the nearest of equal names first.

    No name is more similar than an equal one, and none in a wider ring is nearer, so a school that has found its equal is not asked again.
    """
    key, found = ["school_name", "county_std"], []
    rest = left.where("l_lat is not null and l_lon is not null").checkpoint()
    ref = ref.where("r_lat is not null and r_lon is not null").checkpoint()
    for part in RINGS:
        equal = within(rest, ref, metres / part, ("school_name_std", "ref_std"))
        nearest = known(equal, equal.groupBy(*key).agg(F.min("distance_m").alias("__least")), key).where(F.col("distance_m") == F.col("__least")).drop("__least")
        found.append(nearest.withColumn("jw", F.lit(0.0)).checkpoint())
        done = found[-1].select(*key).distinct().withColumn("__done", F.lit(True))
        rest = known(rest, done, key, "left").where("__done is null").drop("__done").checkpoint()
    signed = lambda df, c, sign: df.join(df.select(c).distinct().withColumn(sign, similarity.signs(c)), c).checkpoint()
    r = signed(ref, "ref_std", "r_sign")
    found.append(nearest_names(signed(rest, "school_name_std", "l_sign"), key, lambda some: within(some, r, metres)))
    return reduce(DataFrame.unionByName, found)


def candidates(schools: DataFrame, ref: DataFrame, prefix: str, metres: float | None = None) -> DataFrame:
    """Schools (school_name, county_std, school_name_std, lat, lon) with their best candidate as columns ``prefix``_...

    Candidates stand in the same county, or with ``metres`` within that distance, which plans as a join of grid cells. Names whose
    bound of the distance excludes them are not compared. The most similar name wins, then the nearest, then the first name.
    """
    durable(schools.sparkSession)
    key = ["school_name", "county_std"]
    left = schools.where("school_name_std is not null").select(*key, "school_name_std", F.col("lat").alias("l_lat"), F.col("lon").alias("l_lon"))
    # of references alike in name, county and point only the first can win
    told, point = ["ref_name", "ref_variant", "ref_city", "ref_status", "ref_detail"], F.col("r_lat").isNotNull() & F.col("r_lon").isNotNull()
    at = ["ref_std", *(["ref_county"] if metres is None else []), "r_lat", "r_lon"]
    ref = ref.where("ref_std is not null").withColumns({c: F.when(point, F.col(c)) for c in ("r_lat", "r_lon")})
    ref = ref.groupBy(*at).agg(F.min(F.struct(*told)).alias("told")).select(*at, "told.*")
    pairs = (best_in_county(left, ref) if metres is None else best_nearby(left, ref, metres)).withColumn("sim", 1 - F.col("jw"))
    best = pairs.groupBy(*key).agg(F.min_by(F.struct(*told, "sim", "distance_m"), F.struct(-F.col("sim"), F.coalesce("distance_m", F.lit(float("inf"))), "ref_name", "ref_variant")).alias("b"))
    fields = {
        "name": F.col("b.ref_name"), "matched_name": F.when(F.col("b.ref_variant") != F.col("b.ref_name"), F.col("b.ref_variant")), "city": F.col("b.ref_city"), "status": F.col("b.ref_status"),
        "detail": F.col("b.ref_detail"), "sim": F.bround("b.sim", 3), "dist_m": F.bround("b.distance_m")}
    return known(schools, best.select(*key, *[v.alias(f"{prefix}_{k}") for k, v in fields.items()]), key, "left")


def review(joined: DataFrame, references: dict[str, DataFrame], directory: DataFrame | None = None, metres: float = 25_000, strong: float = 0.9, possible: float = 0.8, strong_metres: float = 5_000) -> DataFrame:
    """One row per unmatched school with its candidates, the best similarity, an explanation, and blank columns for a reviewer."""
    missing = [c for c in ("school_id", "school_name", "school_name_std_vacc", "county_std", "year_source") if c not in joined.columns]
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    out = unmatched(joined)
    for name, ref in references.items():
        out = candidates(out, reference(ref), name)
    if directory is not None:
        out = candidates(out, directory_reference(directory), "nces", metres)
    sims = [f"{s}_sim" for s in [*references, *(["nces"] if directory is not None else [])]]
    best = F.greatest(*[F.col(s) for s in sims]) if len(sims) > 1 else F.col(sims[0]) if sims else F.lit(None).cast("double")
    no = lambda c: F.coalesce(c, F.lit(False))
    by_name = reduce(lambda x, y: x | y, [no(F.col(f"{s}_sim") >= strong) for s in references], F.lit(False))
    near = no((F.col("nces_sim") >= strong) & (F.col("nces_dist_m") <= strong_metres)) if directory is not None else F.lit(False)
    shut = near & no(F.col("nces_status") == "CLOSED_PERMANENTLY") if directory is not None else F.lit(False)
    renamed = near & F.col("nces_matched_name").isNotNull() if directory is not None else F.lit(False)
    latest = joined.agg(F.max(F.substring("year_source", 1, 4).try_cast("int")).alias("latest_year"))
    out = out.join(F.broadcast(latest)).withColumn("best_sim", best)  # one row
    why = (
        F.when(shut, CLOSED).when(renamed, RENAMED).when(near | by_name, VARIANT).when(no(F.col("best_sim") >= possible), POSSIBLE)
        .when(no(F.col("last_year") < F.col("latest_year") - 1), STOPPED).otherwise(REPORTING)
    )
    still = F.when(no(F.col("last_year") >= F.col("latest_year")), "still reporting in the latest year").otherwise(F.concat(F.lit("last reported "), F.coalesce(F.col("last_year").cast("string"), F.lit("NA"))))
    out = out.withColumns({"likely_explanation": why, "reporting": still, **{c: F.lit(None).cast("string") for c in ("reviewer_decision", "matched_reference_name", "reviewer_notes")}})
    first = ["school_name", "county_std", "reporting", "likely_explanation", "best_sim"]
    return out.select(*first, *[c for c in out.columns if c not in [*first, "school_name_std", "latest_year"]]).orderBy("likely_explanation", F.col("county_std").asc_nulls_last(), "school_name")


HELD = 1 << 19  # pairs of names that a task of match_directory holds at most, about


def match_directory(places: DataFrame, directory: DataFrame, metres: float = 300, least: float = 0.85, share: float = 0.5) -> DataFrame:
    """(place_id, nces_id, nces_source, nces_name, business_status, dist_m, name_sim): one school of a directory per place.

    A place (place_id, lat, lon, name) may have several names, a school (nces_id, nces_source, nces_name, names, lat, lon,
    business_status) several too. More than ``share`` of the place's names must be alike; open schools go first, then by
    similarity, distance and id.
    """
    p = places.where("place_id is not null and lat is not null and lon is not null and name <> ''")
    p = p.select("place_id", F.col("lat").alias("l_lat"), F.col("lon").alias("l_lon"), school_name(F.col("name")).alias("name_std")).distinct()
    n = directory.select("nces_id", "nces_source", "nces_name", "business_status", F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"), F.explode(F.coalesce("names", F.array("nces_name"))).alias("v"))
    n = n.where("r_lat is not null and r_lon is not null").withColumn("v", school_name(F.col("v")))
    p = p.join(p.groupBy("place_id").agg(F.countDistinct("name_std").alias("n_names")), "place_id")
    signed = lambda df, c, sign: df.join(df.select(c).distinct().withColumn(sign, similarity.signs(c)), c)
    p, n = signed(p, "name_std", "l_sign"), signed(n, "v", "r_sign")
    bound = similarity.least_distance(F.col("l_sign"), F.col("r_sign"))
    pairs = within(p, n, metres).where(bound <= 1 - least + similarity.SLACK).drop("l_sign", "r_sign")
    pairs = pairs.withColumn("name_sim", 1 - similarity.sounds("name_std", "v")["jw"]).where(F.col("name_sim") >= least)
    # a task holds so many pairs, not a place with all its schools: each pair of a place and a school is judged alone, and tasks give one school per place
    total = met_keys(*in_cells(p, n, metres), "__cell").agg(F.sum("pairs")).first()[0] or 0
    tasks = min(MOST_TASKS, max(int(total / HELD) + 1, int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    first = F.struct((~F.coalesce(F.col("business_status") == "OPERATIONAL", F.lit(False))).alias("shut"), (-F.col("name_sim")).alias("unlike"), "distance_m", "nces_id", "nces_source", "nces_name", "business_status", "name_sim")
    judged = pairs.repartition(tasks, "place_id", "nces_id").groupBy("place_id", "nces_id").agg(F.countDistinct("name_std").alias("n_alike"), F.max("n_names").alias("n_names"), F.min(first).alias("b"))
    best = judged.where(F.col("n_alike") / F.col("n_names") > share).groupBy("place_id").agg(F.min("b").alias("b"))
    return best.select("place_id", "b.nces_id", "b.nces_source", "b.nces_name", "b.business_status", F.col("b.distance_m").alias("dist_m"), "b.name_sim")


def directory_states(place_ids: DataFrame, rows: DataFrame, names: list[str], directory: DataFrame) -> DataFrame:
    """``match_directory`` for the wanted places, whose names are all those that ``rows`` (place_id, lat, lon, ..) has in ``names``; rows without a state go."""
    long = rows.join(place_ids.select("place_id").distinct(), "place_id", "left_semi").unpivot(["place_id", "lat", "lon"], names, "source", "name")
    return match_directory(long, directory).where("business_status is not null")
