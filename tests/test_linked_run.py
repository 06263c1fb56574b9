"""The linkage run with counting services, and its rehearsal."""

import sys

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from musterline.operators import geocode, runlog
from musterline.plans import catalogue, linked_run

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import the tests
RENAMED = "renamed abbey of quixotic studies"


def states(frames):
    for f in frames:
        names = [RENAMED + " School" if "Pine Hill" in p else None for p in f["place_id"]]
        yield pd.DataFrame({"place_id": f["place_id"], "business_status": "OPERATIONAL", "google_place_name": names, "status_reason": "success", "http_status": pd.array([200] * len(f), "Int32")})


def services(folder, log=None):
    return linked_run.Services(geocode.geocoder(geocode.dry_run, str(folder), rate=None, log=log), geocode.place_service(states, str(folder), rate=None, log=log), "md")


def test_today_s_name_finds_a_school_and_a_rehearsal_counts_what_is_asked(spark, tmp_path):
    shape = "school_name string, school_name_std string, county_std string, school_type string, level_code string, district_std string, addr_clean string, city string, zip string"
    row = lambda name, street: (name, name.lower(), "ada", "public", "e", None, street, None, None)
    one = spark.createDataFrame([(1, *row("Pine Hill", "77 oak street")), (2, *row("Elm", "8 elm street"))], "data1_id long, " + shape).withColumns({"lat": F.lit(None).cast("double"), "lon": F.lit(None).cast("double")})
    two = spark.createDataFrame([(5, *row("Ash", "9 ash street"))], "data2_id long, " + shape)
    records = spark.createDataFrame([(1, *row(RENAMED.title() + "s", None), "2023-24", "Elementary"), (2, *row("Elm", "8 elm street"), "2023-24", "Elementary")], "vacc_data_id long, " + shape + ", year_source string, school_level string").drop("addr_clean", "city", "zip")
    catalogue.durable(spark)
    log = runlog.RunLog("md")
    found = linked_run.linked(records, one, two, services(tmp_path / "a", log))
    got = {r["vacc_data_id"]: (r["school_id"], r["match_method"]) for r in found.joined.collect()}
    assert got[1] == ("dir-1", "fuzzy_county_type") and got[2][0] == "dir-2"  # only its place's name leads to the first
    assert {r["orig_id"]: r["business_status"] for r in found.master.collect()}["dir-1"] == "OPERATIONAL"
    asked = {r["api"]: r["requests"] for r in log.rows()}
    queries = services(tmp_path / "a").geocoder.every(spark)
    assert asked["geocoding"] == queries.select("query").distinct().count() == queries.count() >= 4 and asked["place_details_pro"] == 3
    fresh = services(tmp_path / "none")
    assert {r["api"]: r["requests_ceiling"] for r in linked_run.estimated(records, one, two, fresh).collect()} == asked
    assert fresh.geocoder.every(spark).isEmpty() and fresh.places.every(spark).isEmpty()  # nothing real was asked or written


@pytest.mark.parametrize("bad", [{"slots": 0}, {"chunk": 0}, {"rate": float("inf")}])
def test_settings_are_checked(bad):
    with pytest.raises(ValueError, match="must be"):
        geocode.geocoder(states, "x", **bad)
