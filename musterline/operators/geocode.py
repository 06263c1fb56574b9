"""Places and states of business of schools from injected services, with caches that a later run resumes from.

A geocoder is a provider (``enrich.Provider``) that takes frames of the column query and gives rows of ``ANSWER``; a place
service takes frames of place_id and gives rows of ``DETAILS``. Either may be a ``service.Service``, whose answers are kept, paced and counted.
Each distinct key is asked once, when a function is called and not again by whoever reads its result, and none that a cache answers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, has_street_address, school_name, squish
from .enrich import looked_up
from .runlog import RunLog
from .service import Provider, Service, asked, durable

ANSWER = "query string, found_lat double, found_lon double, found_place_id string, found_address string"
DETAILS = "place_id string, business_status string, google_place_name string, status_reason string, http_status int"
STATUS = ("business_status", "google_place_name", "status_reason", "business_source")
# Reasons of a place look-up that need no other.
RESOLVED = ("success", "not_available")


# ---- queries and answers --------------------------------------------------------------------

def unplaced() -> Column:
    return F.col("lat").isNull() | F.col("lon").isNull()


def asks_by_address() -> Column:
    """A numbered address, but no point or no place."""
    return has_street_address(F.col("addr_clean")) & (unplaced() | F.col("place_id").isNull())


def asks_by_name() -> Column:
    """Neither a point nor a numbered address."""
    return unplaced() & ~has_street_address(F.col("addr_clean"))


def query_of(*columns: str) -> Column:
    return squish(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def address_query() -> Column:
    return query_of("school_name", "addr_clean", "city", "state", "zip")


def name_query() -> Column:
    return query_of("school_name", "county_std", "state", "zip")


def merged_answers(df: DataFrame, prefix: str) -> DataFrame:
    """Columns that start with ``prefix`` as one of that name: the first that is not null, in the order of the table."""
    same = [c for c in df.columns if c.startswith(prefix)]
    kept = F.coalesce(*[F.col(f"`{c}`") for c in same]) if same else F.lit(None).cast("string")
    at = df.columns.index(same[0]) if same else len(df.columns)
    rest = [F.col(f"`{c}`") for c in df.columns if c not in same]
    return df.select(*rest[:at], kept.alias(prefix), *rest[at:])


def parsed_address(df: DataFrame) -> DataFrame:
    """Street, city and zip out of ``formatted_address`` where that starts with a number; the columns stay otherwise."""
    whole, numbered = F.col("formatted_address"), has_street_address(F.col("formatted_address"))
    part = lambda pattern, group: F.nullif(F.trim(F.regexp_extract(whole, pattern, group)), F.lit(""))
    parts = {"addr_clean": part(r"^[^,]+", 0), "city": part(r"^[^,]+,\s*([^,]+)", 1), "zip": part(r"(\d{5})(?=, USA)", 1)}
    return df.withColumns({c: F.when(numbered, v).otherwise(F.col(c)) for c, v in parts.items()})


def _answered(df: DataFrame, wanted: Column, query: Column, cache: DataFrame | None, provider: Provider | Service, caller: str) -> tuple[DataFrame, DataFrame]:
    asking = df.withColumn("query", F.when(wanted, query))
    known, answers = looked_up(asking.where("query is not null"), ["query"], cache, provider, ANSWER, caller)
    return known, asking.join(answers, "query", "left")


def by_address(df: DataFrame, cache: DataFrame | None, provider: Provider | Service) -> tuple[DataFrame, DataFrame]:
    """(cache, rows): rows with a numbered address get a point and a place where they lack one."""
    known, found = _answered(df, asks_by_address(), address_query(), cache, provider, "by_address")
    asked = F.col("query").isNotNull()
    out = found.withColumns({
        "lat": F.coalesce("lat", "found_lat"), "lon": F.coalesce("lon", "found_lon"), "place_id": F.coalesce("place_id", "found_place_id"),
        "formatted_address": F.when(asked, F.coalesce("formatted_address", "found_address")).otherwise(F.col("formatted_address")),
    })
    source = F.when(asked & (F.col("place_id").isNotNull() | F.col("lat").isNotNull()), "google").otherwise(F.col("geo_source"))
    return known, out.withColumn("geo_source", source).drop("query", *[c for c in found.columns if c.startswith("found_")])


def by_name(df: DataFrame, cache: DataFrame | None, provider: Provider | Service) -> tuple[DataFrame, DataFrame]:
    """(cache, rows): rows without point and address get both from the name and the county; new ones win."""
    known, found = _answered(df, asks_by_name(), name_query(), cache, provider, "by_name")
    asked = F.col("query").isNotNull()
    found = found.withColumns({"__addr": F.col("addr_clean"), "__city": F.col("city"), "__zip": F.col("zip"), "__old": F.col("formatted_address")})
    out = found.withColumns({
        "lat": F.coalesce("found_lat", "lat"), "lon": F.coalesce("found_lon", "lon"), "place_id": F.coalesce("place_id", "found_place_id"),
        "formatted_address": F.when(asked, F.coalesce("formatted_address", "found_address")).otherwise(F.col("formatted_address")),
    })
    source = F.when(asked & (F.col("place_id").isNotNull() | F.col("lat").isNotNull()), "google").otherwise(F.col("geo_source"))
    out = parsed_address(out.withColumn("geo_source", source))
    out = out.withColumns({c: F.when(asked, F.col(c)).otherwise(F.col(old)) for c, old in (("addr_clean", "__addr"), ("city", "__city"), ("zip", "__zip"))})
    return known, out.drop("query", "__addr", "__city", "__zip", "__old", *[c for c in found.columns if c.startswith("found_")])


def merge_cache(schools: DataFrame, cache: DataFrame) -> DataFrame:
    """Schools with what an earlier run's rows (one per name and county, or per name where the county is null) know.

    A missing place_id is filled. Address, city, zip and point are replaced only in rows that lack a point or a numbered address.
    """
    given = ["place_id", "addr_clean", "city", "zip", "lat", "lon"]
    order = Window.partitionBy("school_name", "county_std").orderBy(F.col("place_id").isNull(), *[F.col(c).asc_nulls_last() for c in given])
    one = cache.withColumn("__n", F.row_number().over(order)).where("__n = 1")
    one = one.select(F.col("school_name").alias("__name"), F.col("county_std").alias("__county"), *[F.col(c).alias(f"__{c}") for c in given])
    same = (F.col("school_name") == F.col("__name")) & F.col("county_std").eqNullSafe(F.col("__county"))
    needs = unplaced() | ~has_street_address(F.col("addr_clean"))
    new = {"place_id": F.coalesce("place_id", "__place_id")} | {c: F.when(needs, F.coalesce(f"__{c}", c)).otherwise(F.col(c)) for c in given[1:]}
    return schools.join(one, same, "left").withColumns(new).drop("__name", "__county", *[f"__{c}" for c in given])


def geocoded(df: DataFrame, provider: Provider | Service, cache: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(cache with all answers, rows): by address first, then by name for what has none."""
    for c, kind in (("place_id", "string"), ("formatted_address", "string"), ("geo_source", "string"), ("lat", "double"), ("lon", "double")):
        df = df if c in df.columns else df.withColumn(c, F.lit(None).cast(kind))
    durable(df.sparkSession)
    known, out = by_address(df.checkpoint(), cache, provider)
    return by_name(out.checkpoint(), known, provider)  # what is asked next is planned from rows, not from the look-ups before


def dry_run(places: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A provider that sends nothing: each query has a place of its own, so equal queries share one."""
    for frame in places:
        yield pd.DataFrame({"query": frame["query"], "found_lat": 0.0, "found_lon": 0.0, "found_place_id": "dry-" + frame["query"], "found_address": None})


def geocoder(provider: Provider, folder: str, rate: float | None = 50.0, slots: int = 4, chunk: int = 250, log: RunLog | None = None) -> Service:
    """A geocoding service whose answers stay in the folder's cache; an answer with a point or a place is final."""
    return Service("geocoding", provider, ANSWER, cache_paths(folder)["geocode"], "found_lat is not null or found_place_id is not null", rate=rate, slots=slots, chunk=chunk, log=log)


def place_service(provider: Provider, folder: str, rate: float | None = 8.0, slots: int = 2, chunk: int = 250, log: RunLog | None = None) -> Service:
    """A service of states of business whose answers stay in the folder's cache."""
    final = f"status_reason in {RESOLVED}"
    return Service("place_details_pro", provider, DETAILS, cache_paths(folder)["status"], final, "coalesce(cast(http_status as string), 'no response')", rate, slots, chunk, log)


def run(df: DataFrame, provider: Provider, folder: str, rate: float | None = 50.0, log: RunLog | None = None, **given) -> DataFrame:
    """``geocoded`` with the answers kept in the folder's cache, so that a run that was cut off asks only what it had not.

    Questions go out in chunks whose answers are written before the next ones are asked, at most ``rate`` a second. Queries that
    got neither point nor place are asked again by the next run. ``log`` counts the questions; ``given`` goes to ``geocoder``.
    """
    return geocoded(df, geocoder(provider, folder, rate, log=log, **given))[1]


def place_ids(df: DataFrame, id_col: str, names: dict[str, str], provider: Provider | Service, cache: DataFrame | None = None) -> DataFrame:
    """(id, place_id) of rows whose columns ``names`` maps to those that geocoding reads; absent ones are null."""
    reads = ("school_name", "addr_clean", "city", "state", "zip", "county_std", "lat", "lon", "place_id")
    kind = lambda c: "double" if c in ("lat", "lon") else "string"
    have = lambda c: F.col(names.get(c, c)) if names.get(c, c) in df.columns else F.lit(None)
    rows = df.select(F.col(id_col), *[have(c).cast(kind(c)).alias(c) for c in reads])
    return geocoded(rows, provider, cache)[1].select(id_col, "place_id")


def original_then_standard(df: DataFrame, provider: Provider | Service, original: str = "orig_name", standard: str = "school_name_std") -> DataFrame:
    """Rows with the place of their original name, or of the standard one where that has none; ``geocode_name_used`` tells which, or ``failed``.

    Rows without an original name are asked by the standard one at once. Other columns stay as they are.
    """
    whole = df.drop("place_id", "geocode_name_used")

    def asked(rows: DataFrame, name: Column, cache: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        known, out = geocoded(rows.withColumn("__row", F.struct(*whole.columns)).withColumn("school_name", name), provider, cache)
        return known, out.select("__row.*", "place_id").checkpoint()

    known, first = asked(whole, F.coalesce(blank_to_null(F.col(original)), F.col(standard)), None)
    lacks = blank_to_null(F.col("place_id")).isNull()
    _, again = asked(first.where(lacks).drop("place_id"), F.col(standard), known)
    used = F.when(lacks, "failed")
    return first.where(~lacks).withColumn("geocode_name_used", F.lit("original")).unionByName(again.withColumn("geocode_name_used", used.otherwise("standardized")))


# ---- states of business ---------------------------------------------------------------------

def details(fetch: Callable[[str], tuple[int | None, dict | None]]) -> Provider:
    """A place service made of ``fetch``: place_id to an HTTP code (None: no answer) and the parsed body (None: unreadable)."""

    def one(place_id: str):
        if place_id is None or place_id == "":
            return place_id, None, None, "missing_place_id", None
        code, body = fetch(place_id)
        if code == 404:
            return place_id, None, None, "not_available", code
        if code != 200 or body is None:
            return place_id, None, None, "transient_error", code
        return place_id, body.get("businessStatus"), (body.get("displayName") or {}).get("text"), "success", code

    def provider(frames):
        for frame in frames:
            found = pd.DataFrame([one(x) for x in frame["place_id"]], columns=[c.split()[0] for c in DETAILS.split(", ")])
            yield found.astype({"http_status": "Int32"})

    return provider


def status_cache(cache: DataFrame) -> DataFrame:
    """A cache of states of any age in today's columns: one row per place, resolved ones first; a cache of other columns is empty."""
    if not {"place_id", "business_status"} <= set(cache.columns):
        return cache.sparkSession.createDataFrame([], "place_id string, " + ", ".join(f"{c} string" for c in STATUS))
    old = "status_reason" not in cache.columns or "google_place_name" not in cache.columns
    none = F.lit(None).cast("string")
    rows = cache.select(
        "place_id", "business_status", F.col("google_place_name") if "google_place_name" in cache.columns else none.alias("google_place_name"),
        none.alias("status_reason") if old else F.col("status_reason"),
        (F.coalesce("business_source", F.lit("cache")) if "business_source" in cache.columns else F.lit("cache")).alias("business_source"),
    ).where("place_id <> ''")
    order = Window.partitionBy("place_id").orderBy(~F.coalesce(F.col("status_reason").isin(*RESOLVED), F.lit(False)), *[F.col(c).asc_nulls_last() for c in STATUS])
    return rows.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def with_status(df: DataFrame, cache: DataFrame, provider: Provider | Service, listed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with state, name, reason and source of their place, new cache).

    A reference directory (``listed``: place_id, business_status, nces_name, nces_source, nces_id) goes before the cache, the
    cache before the service. The service is asked once for each place that neither resolves; where it fails, what was known stays.
    """
    known = status_cache(cache)
    for c in STATUS:
        df = df if c in df.columns else df.withColumn(c, F.lit(None).cast("string"))
    stale = F.coalesce(F.col("status_reason") == "nces", F.lit(False))  # a directory's answer holds for one run
    df = df.withColumns({c: F.when(~stale, F.col(c)) for c in STATUS}).drop("nces_id")
    cached = known.select("place_id", *[F.col(c).alias(f"__c_{c}") for c in STATUS])
    df = df.join(cached, "place_id", "left").withColumns({c: F.coalesce(f"__c_{c}", c) for c in STATUS}).drop(*cached.columns[1:])
    if listed is None:
        df = df.withColumn("nces_id", F.lit(None).cast("string"))
    else:
        one = listed.select("place_id", F.col("business_status").alias("__business_status"), F.col("nces_name").alias("__google_place_name"), F.lit("nces").alias("__status_reason"), F.col("nces_source").alias("__business_source"), "nces_id")
        df = df.join(one, "place_id", "left").withColumns({c: F.when(F.col("__status_reason").isNotNull(), F.col(f"__{c}")).otherwise(F.col(c)) for c in STATUS})
        df = df.drop(*[f"__{c}" for c in STATUS])
    settled = F.coalesce(F.col("status_reason").isin(*RESOLVED, "nces"), F.lit(False))
    placed = blank_to_null(F.col("place_id")).isNotNull()
    first = lambda c: F.min(F.col(c)).alias(f"__p_{c}")
    prior = df.where(placed & ~settled).groupBy("place_id").agg(*[first(c) for c in STATUS])
    fresh = asked(prior.select("place_id"), provider, DETAILS, "with_status").join(prior, "place_id")
    reason = F.coalesce("status_reason", "__p_status_reason")
    fresh = fresh.select(
        "place_id", F.coalesce("business_status", "__p_business_status").alias("business_status"), F.coalesce("google_place_name", "__p_google_place_name").alias("google_place_name"),
        reason.alias("status_reason"), F.when(reason == "success", "google").otherwise(F.col("__p_business_source")).alias("business_source"))
    new = fresh.select("place_id", *[F.col(c).alias(f"__f_{c}") for c in STATUS])
    df = df.join(new, "place_id", "left").withColumns({c: F.coalesce(f"__f_{c}", c) for c in STATUS}).drop(*new.columns[1:])
    df = df.withColumn("status_reason", F.when(placed, F.col("status_reason")).otherwise("missing_place_id")).withColumn("business_source", F.when(placed, F.col("business_source")))
    return df, fresh.unionByName(known.join(fresh.select("place_id"), "place_id", "left_anti"))


def retried(df: DataFrame, provider: Provider | Service, attempts: int = 5) -> DataFrame:
    """Rows whose look-up failed for the moment, asked again up to ``attempts`` times, until none is left that may change.

    Each round asks every such place once and keeps the answers; rows take their place's last one. Rows without a place get
    the reason ``missing_place_id``.
    """
    again = F.col("business_status").isNull() & F.coalesce(F.col("status_reason") == "transient_error", F.lit(False))
    unsettled = F.col("status_reason").isNull() | ~F.col("status_reason").isin(*RESOLVED)
    keys, rounds = df.where(again & F.col("place_id").isNotNull()).select("place_id").distinct(), []
    for _ in range(attempts):
        found = asked(keys, provider, DETAILS, "retried")
        keys = found.where(unsettled).select("place_id")
        if found.isEmpty():
            break
        rounds.append((found, keys))
        if keys.isEmpty():
            break
    if not rounds:
        return df
    last = rounds[-1][0]
    for found, left in rounds[-2::-1]:
        last = last.unionByName(found.join(left, "place_id", "left_anti"))
    new = last.select("place_id", *[F.col(c).alias(f"__{c}") for c in STATUS[:3]])
    reason = F.when(F.col("place_id").isNull(), "missing_place_id").otherwise(F.col("__status_reason"))
    out = df.join(new, "place_id", "left").withColumn("__again", again).withColumn("__status_reason", reason)
    return out.withColumns({c: F.when(F.col("__again"), F.col(f"__{c}")).otherwise(F.col(c)) for c in STATUS[:3]}).drop("__again", *new.columns[1:])


def failure_codes(found: DataFrame) -> DataFrame:
    """(code, n) of failed look-ups: the HTTP code, or ``no response``."""
    failed = found.where(~F.col("status_reason").isin(*RESOLVED) & (F.col("status_reason") != "missing_place_id"))
    return failed.groupBy(F.coalesce(F.col("http_status").cast("string"), F.lit("no response")).alias("code")).agg(F.count("*").alias("n"))


def with_name_variants(df: DataFrame, states: DataFrame, level_words: Callable[[Column], Column] = school_name) -> DataFrame:
    """Adds the standard form of the name that the place service has today."""
    named = states.select("place_id", level_words(F.col("google_place_name")).alias("google_name_std"))
    return df.join(named, "place_id", "left")


def with_synonyms(df: DataFrame, name: str = "school_name_std") -> DataFrame:
    """The rows, and once more under the service's name where that is another one."""
    other = df.where((F.col("google_name_std") != "") & (F.col("google_name_std") != F.col(name)))
    return df.drop("google_name_std").unionByName(other.withColumn(name, F.col("google_name_std")).drop("google_name_std"))


# ---- cache folders --------------------------------------------------------------------------

def cache_paths(folder: str) -> dict[str, str]:
    return {kind: f"{folder}/{kind}_cache.parquet" for kind in ("geocode", "status", "progress")}


def clear_cache(folder: str, what: str = "status", force: bool = False) -> list[str]:
    """Deletes cache folders (status, geocode, or all) in whatever store they are and names them; without ``force`` only names what it would delete."""
    paths = cache_paths(folder)
    if what not in ("status", "geocode", "all"):
        raise ValueError(f"what is one of status, geocode and all, not {what!r}")
    context = SparkSession.getActiveSession().sparkContext
    chosen = [p for k, p in paths.items() if what == "all" or k == what or (what == "geocode" and k == "progress")]
    targets = {p: context._jvm.org.apache.hadoop.fs.Path(p) for p in chosen}
    stores = {p: t.getFileSystem(context._jsc.hadoopConfiguration()) for p, t in targets.items()}
    found = [p for p in chosen if stores[p].exists(targets[p])]
    if force:
        for p in found:
            stores[p].delete(targets[p], True)
    return found
