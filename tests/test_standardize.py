"""Rosters, cleaners, the linkage run, the modular audit, cost estimates and scaffolds on small cases."""

import pytest
from pyspark.sql import functions as F

from musterline.operators import audit, rosters
from musterline.plans import costs, scaffold, standardize
from musterline.sources import cleaners

RECORD = "vacc_data_id long, school_name string, school_name_std string, county_std string, school_type string, school_level string, level_code string, district_std string, year_source string"


@pytest.fixture(scope="module", autouse=True)
def checkpoints(spark, tmp_path_factory):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


def test_dense_ids(spark):
    got = rosters.dense_id(spark.range(1000).repartition(7).withColumn("x", -F.col("id")), ["x"], "n").collect()
    assert sorted((r["n"], r["id"]) for r in got) == [(i + 1, 999 - i) for i in range(1000)]
    assert rosters.dense_id(spark.range(0), ["id"], "n").count() == 0


def test_unique_schools(spark):
    rows = [(1, "Oak E.", "oak", "a", "public", "Elementary", "e", None, "20"), (2, "Oak", "oak", "a", "public", None, "e", None, "21"),
            (3, "Elm", "elm", "a", "public", "Middle", "m", None, "20"), (4, "Elm", "elm", "a", "public", "Middle", "m", None, "21"), (5, "Elm", "elm", "a", "private", "Middle", "m", None, "22"),
            (6, "Ash", "ash", "b", "public", None, None, None, "20"), (7, "Ash", "ash", "b", "private", None, None, None, "20"), (8, "Ash", "ash", "b", "private", None, None, None, "21"), (9, "Ash", "ash", "b", "public", None, None, None, "22"),
            (10, None, None, None, None, None, None, None, None)]
    listed = spark.createDataFrame([("elm",), ("",), (None,)], "school_name_std string")
    schools, members = rosters.unique_schools(spark.createDataFrame(rows, RECORD), 3, listed)
    got = {(r["school_name_std"], r["school_type"], r["school_level"], r["n_records"], tuple(r["years"])) for r in schools.collect()}
    assert got == {("oak", "public", "Elementary", 2, ("20", "21")), ("elm", "public", "Middle", 3, ("20", "21", "22")), ("ash", "private", None, 4, ("20", "21", "22")), (None, None, None, 1, ())}
    of = {r[0]: r[1] for r in members.collect()}
    assert set(of) == set(range(1, 11)) and of[1] == of[2] and of[3] == of[5] and len({of[i] for i in (6, 7, 8, 9)}) == 1
    assert rosters.unique_schools(spark.createDataFrame([], RECORD), 3)[1].count() == 0


def test_county_slips(spark):
    rows = [(1, "oak", "a", 5, ["20", "21"]), (2, "oak", "b", 1, ["22"]), (3, "elm", "a", 3, ["20"]), (4, "elm", "b", 1, ["20"]), (5, "ash", "a", 1, ["20"]), (6, "ash", "b", 1, ["21"]), (7, "x", None, 1, ["20"])]
    df = spark.createDataFrame(rows, "vacc_school_id long, school_name_std string, county_std string, n_records long, years array<string>")
    assert [tuple(r) for r in rosters.county_slips(df).select("vacc_school_id", "county_std", "corrected_county_std").collect()] == [(2, "b", "a")]


def test_cleaners(spark):
    rows = [(1, "Oak Elementary School", "Prince George's County", "public", "p,e", "P.O. Box 3", 5, 1.0), (2, "Pine High School", "Ada", "private", "h", "12 Oak Avenue Apt 3", 5, 2.0), (3, "Sun Charter", None, None, "p", None, None, None)]
    df = spark.createDataFrame(rows, "id long, name string, county string, schoolType string, levelCode string, street1 string, zip int, lat double").withColumn("lon", F.col("lat"))
    got = {r["id"]: r for r in cleaners.directory(df).collect()}
    assert (got[1]["lat"], got[1]["addr_clean"], got[1]["po_box"], got[1]["school_name_std"], got[1]["school_level"], got[1]["level_code_match"]) == (None, None, True, "oak", "Elementary", "e")
    assert (got[2]["lat"], got[2]["addr_clean"], got[2]["addr_clean_no_unit"], got[2]["school_name_std"]) == (2.0, "12 oak avenue apt 3", "12 oak avenue", "pine")
    assert got[3]["school_type"] == "charter" and not got[3]["po_box"]
    assert {r["id"] for r in cleaners.directory(df, po_box="drop").collect()} == {2, 3}
    assert {r["id"] for r in cleaners.directory(df, elementary_only=True, exclude_prek_only=True).collect()} == {1}
    located = spark.createDataFrame([(2, "Bell County", "7")], "id long, county_geo string, zip_geo string")
    assert {r["id"]: r["county_std"] for r in cleaners.directory(df, located).collect()} == {1: "prince georges", 2: "bell", 3: None}
    with pytest.raises(ValueError, match="po_box"):
        cleaners.directory(df, po_box="x")
    k = cleaners.kindergarten(spark.createDataFrame([("Oak Middle School", "Ada", "Public", "1 Elm St", "Bo", 9)], "school_name string, county string, school_type string, Street string, city string, zipcode int")).first()
    assert (k["school_name_std"], k["level_code"], k["addr_clean"], k["city"], k["zip"]) == ("oak", "m", "1 elm st", "bo", "9")
    assert "addr_clean" not in cleaners.kindergarten(spark.createDataFrame([("Oak", "Ada", "public")], "school_name string, county string, school_type string")).columns
    d = cleaners.department(spark.createDataFrame([("Oak Elementary", "Ada", "PK-5", "1 Elm St", "East School District")], "school_name string, county string, grades string, street string, district string")).first()
    assert (d["level_code"], d["level_code_match"], d["district_std"], d["school_type"]) == ("p,e", "e", "east", None)


def test_linkage_run(spark):
    records = [(1, "Oak Elementary", "Ada", "2020", "1 Elm St"), (2, "Oak Elementary", "Ada", "2021", "1 Elm St"), (3, "Lincolm Elementary", "Ada", "2020", "9 Far Rd"), (4, "Hidden Elementary", "Ada", "2020", "5 Map Rd"),
               (5, "Maple Elementary", "Ada", "2020", None), (6, "Maple Elementary", "Ada", "2021", None), (7, "Maple Elementary", "Bell", "2022", None), (8, "Zzyzx Elementary", "Ada", "2020", None), (9, "Hill High", "Ada", "2020", None), (10, None, None, "2020", None)]
    kinder = spark.createDataFrame(records, "vacc_data_id long, school_name string, county string, year_source string, street string").withColumn("school_type", F.lit("Public"))
    listed = [(1, "Oak Elementary", "Ada", "e", "1 Elm St"), (2, "Lincoln Elementary", "Ada", "e", "2 Elm St"), (3, "Another Name Elementary", "Ada", "e", "3 Elm St"), (4, "Maple Elementary", "Ada", "e", None)]
    web = spark.createDataFrame(listed, "id long, name string, county string, levelCode string, street1 string").withColumns({"schoolType": F.lit("public"), "zip": F.lit(None).cast("string"), "lat": F.lit(1.0), "lon": F.lit(1.0)})
    office = spark.createDataFrame([(1, "Oak Elementary", "Ada", "K-5", "1 Elm St"), (2, "Same Place Elementary", "Ada", "6-8", "3 Elm St"), (3, "New Elementary", "Ada", "K-5", "7 Elm St")], "data2_id long, school_name string, county string, grades string, street string").withColumn("school_type", F.lit("public"))

    def locate(df):
        return df.withColumn("place_id", F.when(F.col("addr_clean").isin("3 elm st", "5 map rd"), "p3"))

    out = standardize.standardize(cleaners.kindergarten(kinder), cleaners.directory(web).withColumnRenamed("id", "data1_id"), cleaners.department(office), locate=locate)
    assert {(r["orig_id"], r["level_code"]) for r in out.master.collect()} == {("dir-1", "e"), ("dir-2", "e"), ("dir-3", "e,m"), ("dir-4", "e"), ("doe-3", "e")}
    joined = out.joined.collect()
    assert sorted(r["vacc_data_id"] for r in joined) == list(range(1, 11))
    got = {r["vacc_data_id"]: (r["school_id"], r["match_method"]) for r in joined}
    assert got[1] == got[2] == ("dir-1", "exact") and got[4] == ("dir-3", "place_id") and got[3][0] == "dir-2" and got[3][1].startswith("fuzzy")
    assert got[5] == got[6] == ("dir-4", "exact") and got[7] == ("dir-4", "county_corrected")
    assert all(got[i][0].startswith("vacc-") and got[i][1] is None for i in (8, 9, 10))


def test_modular_audit(spark):
    rows = [(1, 2020, 100, 90, 5, 3, 2), (1, 2020, 100, 90, 5, 3, 2), (1, 2021, 10, 20, -1, 0, 0), (2, 2020, 50, 0, 0, 0, 0), (2, 2020, 51, 0, 0, 0, 0), (3, 2020, None, 5, None, 0, 0)]
    df = spark.createDataFrame(rows, "school_id int, year int, enrollment int, current int, delayed int, med_exempt int, rel_exempt int")
    out = audit.run_checks(df)
    got = {r["check"]: r["issue_count"] for r in out.summary.collect()}
    assert got == {"duplicates_conflicting": 2, "negative_values": 1, "exceeding_enrollment": 1, "coverage_outliers": 1, "over_coverage": 1, "enrollment_deviation": 2, "vaccination_deviation": 2, "extreme_outliers": 0}
    assert out.cleaned.count() == 5 and audit.consolidated(out.results).columns[0] == "dqa_check"
    with pytest.warns(UserWarning, match="unknown checks: nope"):
        assert [r["check"] for r in audit.run_checks(df, ["negatives", "nope"]).summary.collect()] == ["negative_values"]
    assert audit.run_checks(df.limit(0)).summary.agg(F.sum("issue_count")).first()[0] == 0


def test_costs(spark):
    counted = spark.createDataFrame([("geocoding", 5399), ("place_details_pro", 20000)], "api string, requests long")
    prior = costs.month_to_date(spark.sql("select 'geocoding' api, 9000L requests, date'2026-01-03' run_date union all select 'geocoding', 5, date'2025-12-01'"), "2026-01")
    got = {r["api"]: r for r in costs.estimate(counted, prior).collect()}
    assert got["geocoding"]["requests_expected"] == 4643 and got["geocoding"]["usd_after_free_ceiling"] == 22.0 and got["place_details_pro"]["usd_after_free_ceiling"] == 255.0
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "name string")
    assert costs.would_ask(df, ["name"], df.where("name = 'a'")).first()["requests"] == 1


def test_scaffold(tmp_path):
    paths = scaffold.folders(str(tmp_path), "MD")
    assert paths["kinder_dir"].is_dir() and len(paths) == 12
    for kind in scaffold.SCRIPTS:
        compile(scaffold.script(kind, "md", str(tmp_path)).read_text(), kind, "exec")
    with pytest.raises(FileExistsError):
        scaffold.script("cleaning", "md", str(tmp_path))
    with pytest.raises(ValueError, match="two letters"):
        scaffold.folders(str(tmp_path), "Maryland")


def test_every_part_is_a_record(spark):
    from musterline.plans import catalogue

    parts = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    records, _, _ = catalogue.rosters_of(spark, "/root/testdata/sf0.001")
    assert records.count() == 2 * parts.count() == records.select("vacc_data_id").distinct().count()
