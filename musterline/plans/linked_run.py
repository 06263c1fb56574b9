"""The linkage run with its outside services: places, today's names and states of business, and a rehearsal that sends nothing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import geocode
from ..operators.runlog import RunLog
from ..operators.service import Service, durable
from . import costs, standardize


class Services(NamedTuple):
    """The services of one state's run; each has its answer log."""

    geocoder: Service
    places: Service
    state: str


def locator(services: Services) -> standardize.Locator:
    """Adds the place of each school: of its own name, or of the standard one where that has none."""

    def locate(df: DataFrame) -> DataFrame:
        text = lambda c: (F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c)
        rows = df.select(
            "orig_id", F.col("school_name").alias("orig_name"), "school_name_std", *[text(c) for c in ("addr_clean", "city", "zip", "county_std")], F.lit(services.state.upper()).alias("state"),
            *[(F.col(c).try_cast("double") if c in df.columns else F.lit(None).cast("double")).alias(c) for c in ("lat", "lon")])
        found = geocode.original_then_standard(rows, services.geocoder).select("orig_id", "place_id")
        return df.drop("place_id").join(found, "orig_id", "left")

    return locate


def with_states(df: DataFrame, services: Services, attempts: int = 0) -> DataFrame:
    """Rows with the state of business, name and reason of their place; failures are asked again up to ``attempts`` times."""
    known = services.places.answers(df.sparkSession)
    durable(df.sparkSession)
    out = geocode.with_status(df, known, services.places)[0].checkpoint()
    return geocode.retried(out, services.places, attempts) if attempts else out


def synonyms(services: Services) -> standardize.Locator:
    """Adds each school once more under the name that its place has today."""

    def named(df: DataFrame) -> DataFrame:
        states = with_states(df.select("place_id").where("place_id is not null").distinct(), services).select("place_id", "google_place_name")
        return geocode.with_synonyms(geocode.with_name_variants(df, states))

    return named


def linked(records: DataFrame, directory: DataFrame, department: DataFrame, services: Services, other: DataFrame | None = None, attempts: int = 5, **ids) -> standardize.Standardized:
    """``standardize`` with places for its schools, today's names among the candidates of similar names, and states of business in the master list."""
    found = standardize.standardize(records, directory, department, other, locator(services), synonyms=synonyms(services), **ids)
    return found._replace(master=with_states(found.master, services, attempts))


def dry_places(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A place service that sends nothing: every place is known and has no other name."""
    for frame in frames:
        yield pd.DataFrame({"place_id": frame["place_id"], "business_status": "OPERATIONAL", "google_place_name": None, "status_reason": "success", "http_status": pd.array([200] * len(frame), "Int32")})


def rehearsed(services: Services, spark: SparkSession, log: RunLog, use_cache: bool = True) -> Services:
    """The services as stand-ins that count into ``log``. Their logs are copies, so nothing real is sent or written."""
    durable(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/rehearsal-{uuid.uuid4().hex}"
    return Services(
        services.geocoder.rehearsal(spark, f"{folder}/geocode", geocode.dry_run, log, use_cache),
        services.places.rehearsal(spark, f"{folder}/places", dry_places, log, use_cache), services.state)


def estimated(records: DataFrame, directory: DataFrame, department: DataFrame, services: Services, other: DataFrame | None = None, prior: DataFrame | None = None, use_cache: bool = True, **ids) -> DataFrame:
    """What ``linked`` on these tables would cost (``costs.estimate``): the whole run is rehearsed and its questions are counted."""
    spark, log = records.sparkSession, RunLog(services.state)
    linked(records, directory, department, rehearsed(services, spark, log, use_cache), other, **ids)
    counted = [(r["api"], r["requests"]) for r in log.rows()]
    return costs.estimate(spark.createDataFrame(counted, "api string, requests long"), prior)
