"""Look-ups, directories, files and logs with stub services, and reshaping of odd tables."""

import io
import json
import zipfile
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from musterline.functions import locations, similarity, text
from musterline.operators import geocode, reports, review, runlog
from musterline.plans.catalogue import durable
from musterline.sources import directories, files, reshape


def test_public_directory_skips_the_future_and_stops_at_a_gap(spark):
    asked = []

    def fetch(year, page):
        asked.append((year, page))
        if year > 2022 or year == 2019:
            return json.dumps({"results": [], "next": None})
        row = {"year": year, "ncessch": "1", "school_name": f"Oak {year} {page or 1}", "school_status": 1, "latitude": 1.5, "longitude": 2.5}
        return json.dumps({"results": [row], "next": "2" if page is None and year == 2021 else None})

    got = directories.public_schools(spark, fetch, 2024, 2010).collect()
    assert sorted((r["year"], r["school_name"]) for r in got) == [(2020, "Oak 2020 1"), (2021, "Oak 2021 1"), (2021, "Oak 2021 2"), (2022, "Oak 2022 1")]
    assert asked[-1] == (2019, None)
    with pytest.raises(ValueError, match="no public directory"):
        directories.public_schools(spark, lambda y, p: '{"results": []}', 2024, 2020)


def test_private_editions(spark):
    def archive(start):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr(f"pss{start}.csv", f"PPIN,PINST,PSTABB,LATITUDE{start % 100},LONGITUDE{start % 100}\nA1,Oak,MD,1.5,2.5\nA2,Elm,WI,1,2\nA3,Ash,MD,,\n")
        return out.getvalue()

    fetch = lambda start: (404, None) if start == 2021 else (200, archive(start))
    got = directories.private_schools(spark, fetch, "MD", 2024, 2018).collect()
    assert sorted((r["ppin"], r["year"], r["latitude"]) for r in got if r["ppin"] == "A1") == [("A1", 2018, 1.5), ("A1", 2020, 1.5), ("A1", 2024, 1.5)]
    assert all(r["latitude"] is None for r in got if r["ppin"] == "A3")
    with pytest.raises(ValueError, match="HTTP 500"):
        directories.private_schools(spark, lambda s: (500, None), "MD", 2024, 2018)


def test_directory_cache(spark, tmp_path):
    durable(spark)
    calls = []

    def download(first):
        calls.append(first)
        if len(calls) > 2:
            raise OSError("down")
        return spark.createDataFrame([(len(calls),)], "n int")

    load = lambda **k: directories.load_directory(spark, str(tmp_path), "MD", download, **k)
    value = lambda found: (found[0].first()["n"], found[1])
    assert value(load(first=2015, now=0.0)) == (1, False)
    assert value(load(first=2016, now=86400.0)) == (1, False)  # fresh, and reaches back far enough
    assert value(load(first=2010, now=86400.0)) == (2, False)  # does not reach back
    assert value(load(first=2010, now=1e9)) == (2, True)  # old, and the download fails
    with pytest.raises(OSError):
        directories.load_directory(spark, str(tmp_path / "other"), "MD", download)


def test_files(spark, tmp_path):
    def fetch(link):
        if link == "bad":
            raise OSError("refused")
        return b"x"

    assert directories.saved_files({"a_raw.csv": "good", "b.csv": "bad"}, str(tmp_path), fetch) == {"bad": "refused"}
    assert directories.raw_state_file(str(tmp_path)).endswith("a_raw.csv") and directories.raw_state_file(str(tmp_path / "none")) is None
    files.write_sheet([["School Name", "n"], ["Oak & Elm", 3], [None, 1.5]], str(tmp_path / "r.xlsx"))
    assert [tuple(r) for r in files.read_sheet(spark, str(tmp_path / "r.xlsx")).collect()] == [("Oak & Elm", "3"), (None, "1.5")]
    summary = spark.createDataFrame([("zero", 3)], "check string, issue_count int")
    files.write_summary(reports.with_metadata(summary, "MD", None), str(tmp_path / "s.xlsx"))
    assert tuple(files.read_sheet(spark, str(tmp_path / "s.xlsx")).first()) == ("MD", "zero", "3")
    with pytest.raises(ValueError, match="unknown report format"):
        files.write_summary(summary, str(tmp_path / "s.doc"))
    written = files.write_details({"zero": summary, "none": summary.limit(0)}, str(tmp_path), summary)
    assert written == ["zero", "consolidated"] and spark.read.csv(str(tmp_path / "zero.csv"), header=True).count() == 1
    (tmp_path / "o.csv").write_text("school_name,county\nOak,x\n")
    with pytest.raises(ValueError, match="missing columns: school_type"):
        directories.other_source(spark, str(tmp_path / "o.csv"), lambda df: df)
    assert directories.other_source(spark, None, lambda df: df) is None


def test_failures_in_one_pass(spark, tmp_path):
    rows = [(1, -5), (2, 0), (3, None), (4, 900), (5, -700), (5, -700)]
    df = spark.createDataFrame(rows, "id long, n long").repartition(3)
    checks = {"negative": F.col("n") < 0, "wide": F.abs("n") > 500, "none": F.col("n") > 10_000}
    folder = str(tmp_path / "failures")
    for kind in ("parquet", "csv"):
        assert files.write_failures(df, checks, folder, kind) == {"negative": 3, "wide": 3, "none": 0}
        found = spark.read.option("header", True).format(kind).load(folder).selectExpr("string(check)", "bigint(id)", "bigint(n)")
        assert sorted(map(tuple, found.collect())) == sorted((k, i, n) for k, f in (("negative", lambda n: n < 0), ("wide", lambda n: abs(n) > 500)) for i, n in rows if n is not None and f(n))
    assert files.write_failures(df.limit(0), checks, folder, "parquet") == dict.fromkeys(checks, 0)
    assert files.write_failures(df, {}, folder) == {}
    with pytest.raises(ValueError, match="column 'check' of its own"):
        files.write_failures(df.withColumn("check", F.lit(1)), checks, folder)


def test_run_log(tmp_path):
    for day, requests in ((1, 9_000), (2, 3_000)):
        log = runlog.RunLog("md", datetime(2024, 3, day))
        log.add("geocoding", "by address", requests - 10, requests - 12, Counter({"500": 2}))
        log.add("geocoding", "by name", 10, 9, Counter({"404": 1}))
        path = log.write(str(tmp_path), finished_at=datetime(2024, 3, day))
        assert len(open(path).readlines()) == 3
    assert [r["failure_codes"] for r in log.rows()] == ["500: 2; 404: 1"]
    runlog.RunLog("", datetime(2024, 4, 1)).write(str(tmp_path))
    history = [line.split(",") for line in (tmp_path / "api_calls_all_runs.csv").read_text().splitlines()]
    at = {name: i for i, name in enumerate(history[0])}
    assert [(r[at["month_to_date_requests"]], float(r[at["est_cost_after_free_usd"]])) for r in history[1:]] == [("9000", 0.0), ("12000", 10.0)]
    assert reports.summary_lines({"a": 1, "bb": 1200}) == ["bb      1,200", "a           1"]


def test_cache_folders(spark, tmp_path):
    paths = geocode.cache_paths(str(tmp_path))
    for p in paths.values():
        (tmp_path / p).mkdir()
    assert geocode.clear_cache(str(tmp_path)) == [paths["status"]] and len(list(tmp_path.iterdir())) == 3
    geocode.clear_cache(str(tmp_path), "geocode", force=True)
    assert [str(p) for p in tmp_path.iterdir()] == [paths["status"]]
    with pytest.raises(ValueError, match="what is one of"):
        geocode.clear_cache(str(tmp_path), "x")


def test_dry_run_shares_places(spark):
    rows = spark.createDataFrame([(1, "A", "1 Oak"), (2, "A", "1 Oak"), (3, "B", "1 Oak")], "id int, school_name string, addr_clean string")
    for c in ("city", "state", "zip", "county_std"):
        rows = rows.withColumn(c, F.lit("x"))
    got = {r["id"]: r["place_id"] for r in geocode.geocoded(rows, geocode.dry_run)[1].collect()}
    assert got[1] == got[2] != got[3]


def test_vaccine_types():
    assert reshape.chosen_types(["MMR ", "Polio", None], None) == ["mmr", "polio"]
    with pytest.warns(UserWarning, match="hib"):
        assert reshape.chosen_types(["MMR", "Polio"], ["polio", "Hib", "mmr"]) == ["polio", "mmr"]
    with pytest.raises(ValueError, match="none of"), pytest.warns(UserWarning):
        reshape.chosen_types(["MMR"], ["x"])
    assert reshape.folder_names(["MMR (2)", "mmr 2", "--", "Hep B"]) == ["mmr_2", "mmr_2_1", "type", "hep_b"]


def test_names_and_levels(spark):
    rows = spark.createDataFrame([("Élan::Sub-A::NA",), ("::",), (None,)], "n string")
    assert [r["x"] for r in rows.select(locations.plain_location(F.col("n")).alias("x")).collect()] == ["elan::sub-a", "", None]
    names = spark.createDataFrame([("oak elementry skool",), ("elm high road high",), ("pine middle school",)], "n string")
    assert [r["x"] for r in names.select(text.without_level(F.col("n")).alias("x")).collect()] == ["oak", "elm high road", "pine"]
    listed = spark.createDataFrame([("Baltimore",), ("Howard",), ("Harford",)], "name string")
    asked = spark.createDataFrame([("baltimor",), ("Howard",), ("zzz",), (None,)], "name string")
    got = {r["name"]: r["matched"] for r in locations.match_locations(asked, listed).collect()}
    assert got == {"baltimor": "Baltimore", "Howard": "Howard", "zzz": None}
    assert similarity.winkler([b"", b"", b"ab"], [b"", b"x", b"ab"]).tolist() == [0.0, 1.0, 0.0]


def test_review_without_references(spark):
    rows = [(None, "Oak", "oak", "c", "2020-21"), (None, "Oak", "oak", "c", "2022-23"), (1, "Elm", "elm", "c", "2023-24"), (None, "Ash", "ash", None, "2018-19")]
    joined = spark.createDataFrame(rows, "school_id int, school_name string, school_name_std_vacc string, county_std string, year_source string")
    got = {r["school_name"]: r for r in review.review(joined, {}).collect()}
    assert got["Oak"]["likely_explanation"] == review.REPORTING and got["Oak"]["reporting"] == "last reported 2022" and got["Oak"]["n_years"] == 2
    assert got["Ash"]["likely_explanation"] == review.STOPPED and got["Ash"]["best_sim"] is None
    with pytest.raises(ValueError, match="missing columns: year_source"):
        review.review(joined.drop("year_source"), {})
