"""Directories from outside: yearly lists of public schools as JSON pages, of private schools as zipped csv, and web search pages.

Nothing here opens a connection: ``fetch`` functions are given, and every download lands in a Parquet cache beside its metadata.
"""

from __future__ import annotations

import io
import json
import re
import time
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from .files import read_table, write_report

PUBLIC = "year int, ncessch string, school_name string, school_status int, latitude double, longitude double"
PRIVATE = "ppin string, school_name string, latitude double, longitude double, year int"
# States of a public school in its directory, and fields of a school in a search page.
OPEN_CODES, CLOSED_CODES, INACTIVE_CODES = (1, 3, 4, 5, 8), (2,), (6,)
SCHOOL = "id string, name string, gradeLevels string, districtId string, districtName string, districtCity string, lat double, lon double, state string, levelCode string, schoolType string, type string, enrollment int"
PLACE = "street1 string, street2 string, zip string, city string"


def start_year(year_source: Column) -> Column:
    """The first year that a label names: four digits, else two before a dash, slash or underscore and two more."""
    four = F.regexp_extract(year_source, r"(?<![0-9])(19|20)[0-9]{2}(?![0-9])", 0).try_cast("int")
    two = F.regexp_extract(year_source, r"(?<![0-9])([0-9]{2})[-_/][0-9]{2}(?![0-9])", 1).try_cast("int")
    return F.coalesce(four, 2000 + two)


def first_year(records: DataFrame, fallback: int = 2015, column: str = "year_source") -> DataFrame:
    """One row, first_year: the year before the first that the records name, ``fallback`` if none does."""
    return records.agg(F.coalesce(F.min(start_year(F.col(column).cast("string"))) - 1, F.lit(fallback)).alias("first_year"))


def public_schools(spark: SparkSession, fetch: Callable[[int, str | None], str], last: int, first: int) -> DataFrame:
    """Rows of all years from ``last`` down to ``first``; ``fetch`` takes a year and the next page's address (None: the first page).

    Years that are not out yet are skipped, the first gap after that ends the run. Pages are parsed by Spark, not here.
    """
    texts, seen = [], False
    for year in range(last, first - 1, -1):
        page, found = None, []
        while True:
            text = fetch(year, page)
            found.append(text)
            page = json.loads(text).get("next")
            if not page:
                break
        if not any(json.loads(t).get("results") for t in found):
            if seen:
                break
            continue
        seen = True
        texts += [(t,) for t in found]
    if not texts:
        raise ValueError("no public directory came back")
    return public_rows(spark.createDataFrame(texts, "page string"))


def public_rows(pages: DataFrame) -> DataFrame:
    """Schools of pages (column page, JSON with an array results)."""
    fields = ", ".join(f"{n}:{t}" for n, t in (x.split() for x in PUBLIC.split(", ")))
    shape = f"results array<struct<{fields}>>"
    return pages.select(F.explode(F.from_json("page", shape)["results"]).alias("r")).select("r.*")


def edition_rows(archive: bytes, state: str, rows: int = 10_000) -> Iterator[pd.DataFrame]:
    """The state's schools of one edition of the private list: a zip with a csv whose coordinate columns have an edition's suffix, read in pieces."""
    with zipfile.ZipFile(io.BytesIO(archive)) as z, z.open(next(n for n in z.namelist() if n.lower().endswith(".csv"))) as part:
        for frame in pd.read_csv(part, dtype=str, encoding="utf-8-sig", chunksize=rows):
            frame.columns = [c.upper() for c in frame.columns]
            lat, lon = (next(c for c in frame.columns if c.startswith(p)) for p in ("LATITUDE", "LONGITUDE"))
            frame = frame[frame["PSTABB"] == state]
            yield pd.DataFrame({"ppin": frame["PPIN"], "school_name": frame["PINST"], "latitude": frame[lat].astype(float), "longitude": frame[lon].astype(float)})


def private_schools(spark: SparkSession, fetch: Callable[[int], tuple[int, bytes | None]], state: str, last: int, first: int) -> DataFrame:
    """All editions (odd autumns) from ``last`` down to the one in force in ``first``; ``fetch`` gives a code and the archive, 404 means there is none.

    Tasks fetch and unpack, one edition at a time; the rows are checkpointed, so an edition is fetched once and no archive reaches the driver.
    """
    starts = list(range(last - (last % 2 == 0), first - 2, -2))
    wanted = spark.createDataFrame([(s,) for s in starts], "start int").repartition(max(1, len(starts)))

    def unpacked(frames):
        for frame in frames:
            for start in frame["start"]:
                code, archive = fetch(int(start))
                whole = code == 200 and archive is not None
                yield pd.DataFrame({"code": [code], "whole": [whole], "school": [False], "ppin": [None], "school_name": [None], "latitude": [None], "longitude": [None], "year": [int(start) + 1]})
                for rows in edition_rows(archive, state) if whole else ():
                    yield rows.assign(code=code, whole=True, school=True, year=int(start) + 1)

    read = wanted.mapInPandas(unpacked, f"code int, whole boolean, school boolean, {PRIVATE}").checkpoint()
    came = read.where("not school").orderBy(F.desc("year")).select("code", "whole", "year").collect()  # a row per edition
    for r in came:
        if r["code"] != 404 and not r["whole"]:
            raise ValueError(f"HTTP {r['code']} for the edition of {r['year'] - 1}")
    if not any(r["whole"] for r in came):
        raise ValueError("no private editions came back")
    return read.where("school").select("ppin", "school_name", "latitude", "longitude", "year")


def _summary(df: DataFrame, key: str, state: Column, source: str) -> DataFrame:
    """Per school: latest name, all names (latest first), latest whole point, last year, and its state; schools without a point go."""
    point = F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), F.col("year"))
    names = F.array_distinct(F.transform(F.reverse(F.array_sort(F.collect_set(F.struct("year", "school_name")))), lambda x: x["school_name"]))
    extra = [F.max_by("school_status", "year").alias("last_status")] if "school_status" in df.columns else []
    grouped = df.groupBy(F.col(key).cast("string").alias("nces_id")).agg(
        F.max_by("school_name", "year").alias("nces_name"), names.alias("names"), F.max_by("latitude", point).alias("lat"), F.max_by("longitude", point).alias("lon"), F.max("year").alias("last_seen"), *extra)
    newest = df.agg(F.max("year").alias("newest"))
    out = grouped.where("lat is not null and lon is not null").join(F.broadcast(newest)).withColumn("business_status", state)  # one row
    return out.select("nces_id", F.lit(source).alias("nces_source"), "nces_name", "names", "lat", "lon", F.col("last_seen").cast("int"), "business_status")


def public_summary(df: DataFrame) -> DataFrame:
    """A school that the newest year does not list is closed, else its last state decides."""
    code = F.col("last_status")
    state = (
        F.when((F.col("last_seen") < F.col("newest")) | code.isin(*CLOSED_CODES), "CLOSED_PERMANENTLY").when(code.isin(*INACTIVE_CODES), "CLOSED_TEMPORARILY").when(code.isin(*OPEN_CODES), "OPERATIONAL")
    )
    return _summary(df, "ncessch", state, "nces_ccd")


def private_summary(df: DataFrame) -> DataFrame:
    """A school that the newest edition lists is open; of others nothing is known."""
    return _summary(df, "ppin", F.when(F.col("last_seen") == F.col("newest"), "OPERATIONAL"), "nces_pss")


def load_directory(spark: SparkSession, folder: str, state: str, download: Callable[[int], DataFrame], first: int = 2015, max_age_days: float = 180, refresh: bool = False, now: float | None = None) -> tuple[DataFrame, bool]:
    """(directory, whether it is stale). The cached one serves if it is fresh and reaches back to ``first``; else ``download(first)`` replaces it.

    If the download fails, the cached one serves however old it is. Metadata stands in the cache's own rows.
    """
    path, now = f"{folder}/directory_{state.lower()}.parquet", time.time() if now is None else now
    try:
        cached = spark.read.parquet(path)
        meta = cached.select("downloaded_at", "first_year").first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        cached = meta = None
    if meta is not None and not refresh and now - meta["downloaded_at"] <= max_age_days * 86400 and meta["first_year"] <= first:
        return cached.drop("downloaded_at", "first_year"), False
    try:
        fresh = download(first).withColumn("downloaded_at", F.lit(float(now))).withColumn("first_year", F.lit(first))
        rows = fresh.checkpoint()
    except (OSError, ValueError):
        if meta is None:
            raise
        return cached.drop("downloaded_at", "first_year"), True
    rows.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).drop("downloaded_at", "first_year"), False


# ---- web search pages -----------------------------------------------------------------------

def page_schools(html: Column) -> Column:
    """The schools of a search page, as an array of structs; null without any."""
    fields = lambda spec: ", ".join(f"{n}: {t}" for n, t in (x.split() for x in spec.split(", ")))
    text = F.nullif(F.regexp_extract(html, r"gon\.search=([^;]+);", 1), F.lit(""))
    return F.from_json(text, f"schools array<struct<{fields(SCHOOL)}, address: struct<{fields(PLACE)}>>>")["schools"]


def paged(fetch: Callable[[str, int], tuple[int, str]]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For ``mapInPandas`` over a column zip: (zip, page, html) of every page up to the first that fails or holds no schools."""

    def run(frames):
        for frame in frames:
            rows = []
            for z in frame["zip"]:
                page = 1
                while True:
                    code, html = fetch(z, page)
                    found = re.search(r"gon\.search=([^;]+);", html or "") if code == 200 else None
                    if not found or not json.loads(found[1]).get("schools"):
                        break
                    rows.append((z, page, html))
                    page += 1
            yield pd.DataFrame(rows, columns=["zip", "page", "html"])

    return run


def listed(pages: DataFrame) -> DataFrame:
    """One row per school of pages (html), its address flattened."""
    return pages.select(F.explode(page_schools(F.col("html"))).alias("s")).select("s.*").select("*", "address.*").drop("address")


def scraped(zips: DataFrame, fetch: Callable[[str, int], tuple[int, str]], state: str, crosswalk: DataFrame) -> DataFrame:
    """Schools of all zips of a state with the county that has most of the zip, and in county2 those that have less.

    ``crosswalk`` (state, county, zip, ratio): a zip in several lesser counties gives a row for each.
    """
    own = crosswalk.where(F.col("state") == state.upper())
    wanted = zips.select("zip").join(own.select("zip"), "zip", "left_semi").distinct()
    schools = listed(wanted.mapInPandas(paged(fetch), "zip string, page int, html string"))
    main = own.where("ratio >= 0.5").select("zip", "state", "county")
    lesser = own.where("ratio < 0.5").select("zip", "state", F.col("county").alias("county2"))
    out = schools.join(main, ["zip", "state"], "left").join(lesser, ["zip", "state"], "left")
    return out.select("state", "county", "county2", *[c for c in out.columns if c not in ("state", "county", "county2")])


def state_sources(spark: SparkSession, state: str, state_name: str, zips: DataFrame, crosswalk: DataFrame, fetch: Callable[[str, int], tuple[int, str]],
                  surveys: tuple[DataFrame, DataFrame, DataFrame], folder: str, survey_folder: str) -> tuple[DataFrame, DataFrame]:
    """(schools, coverage) of a state from sources that are alike for all states: search pages, with types in one spelling, and the three surveys (child, school, teen).

    Schools are kept as ``schools.parquet`` and ``schools.csv`` in ``folder``, coverage as ``vax_view.parquet`` in ``survey_folder``. The
    Parquet table is written first and all else is read from it, so a page is fetched once, or again by a task that Spark repeats.
    """
    from . import survey

    rows = scraped(zips, fetch, state, crosswalk).withColumn("schoolType", text.school_type(F.col("schoolType")))
    rows.write.mode("overwrite").parquet(f"{folder}/schools.parquet")
    schools = spark.read.parquet(f"{folder}/schools.parquet")
    write_report(schools, f"{folder}/schools.csv")
    return schools, survey.vaxview(spark, *surveys, state_name, f"{survey_folder}/vax_view.parquet", pull=True)


# ---- files ----------------------------------------------------------------------------------

def saved_files(links: dict[str, str], folder: str, fetch: Callable[[str], bytes]) -> dict[str, str]:
    """Downloads by file name; gives the links that failed with the reason, and goes on with the rest."""
    target, failed = Path(folder), {}
    target.mkdir(parents=True, exist_ok=True)
    for name, link in links.items():
        try:
            (target / name).write_bytes(fetch(link))
        except (OSError, ValueError) as e:
            failed[link] = str(e)
    return failed


def raw_state_file(folder: str) -> str | None:
    """The first csv or xlsx file with ``raw`` in its name, None without any."""
    found = sorted(p for p in Path(folder).glob("*") if p.suffix.lower() in (".csv", ".xlsx") and "raw" in p.name.lower())
    return str(found[0]) if found else None


def other_source(spark: SparkSession, path: str | None, clean: Callable[[DataFrame], DataFrame], required=("school_name", "county", "school_type", "street", "city", "zip", "grades")) -> DataFrame | None:
    """A further source of schools, cleaned; None where there is no file. It must have the required columns."""
    if path is None:
        return None
    df = read_table(spark, path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    return clean(df)
