"""String measures, matchers, distance joins, files and registered queries."""

import io
import random
import zipfile

import duckdb
import pytest
from pyspark.sql import functions as F

from musterline.functions import similarity
from musterline.operators import enrich, linkage, places, rollups
from musterline.plans import catalogue, model_tables, roster_queries  # noqa: F401 - registers its queries
from musterline.sources import contract, files

SF = "/root/testdata/sf0.001"


def test_known_distances():
    assert similarity.osa(b"cat", b"bat") == 1 and similarity.osa(b"ca", b"ac") == 1 and similarity.osa(b"abc", b"xyz") == 3
    assert similarity.jaro_winkler(b"lincoln", b"lincoln") == 0 and similarity.jaro_winkler(b"", b"a") == 1 and similarity.jaro_winkler(b"abc", b"xyz") == 1
    assert [similarity.soundex(x) for x in (b"Lee", b"Washington", b"Tymczak", b"Ashcraft", b"4th st")] == ["L000", "W252", "T522", "A261", "4323"]


def test_unigram_measures(spark):
    rows = [("cat", "bat"), ("abc", "xyz"), ("lincoln", "lincoln"), ("a", None), ("é", "e")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select(similarity.qgram(F.col("a"), F.col("b")), similarity.cosine(F.col("a"), F.col("b")), similarity.jaccard(F.col("a"), F.col("b")), similarity.edits("a", "b")["osa"]).collect()
    assert got[0][0] == 2 and tuple(got[1]) == (6, 1, 1, 3) and got[2][0] == 0 and abs(got[2][1]) < 1e-12 and tuple(got[3]) == (None,) * 4
    assert got[4][0] == 3  # bytes, not characters


def test_fuzzy_blocks(spark):
    left = spark.createDataFrame([(1, "lincoln", "a"), (2, "lincon", "a"), (3, "zzz", "a"), (4, "lincoln", None), (5, None, "a")], "id1 long, name string, county string")
    right = spark.createDataFrame([(10, "lincoln", "A"), (11, "washington", "a"), (12, "lincoln", None)], "id2 long, name string, county string")
    one = linkage.fuzzy(left, right, "name", ["county"], "id1", "id2")
    assert {(r[0], r[1]) for r in one.matched.select("orig_id_1", "orig_id_2").collect()} == {(1, 10), (2, 10)}
    two = linkage.fuzzy(left.withColumn("t", F.lit(None).cast("string")), right.withColumn("t", F.lit(None).cast("string")), "name", ["county", "t"], "id1", "id2")
    assert {(r[0], r[1]) for r in two.matched.select("orig_id_1", "orig_id_2").collect()} == {(1, 10), (2, 10), (4, 12)}
    assert {r["id1"] for r in one.left.collect()} == {3, 4, 5}
    plan = one.matched._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_cascade_keeps_the_right_side(spark):
    left = spark.createDataFrame([(1, "oak", "a"), (2, "oaks", "a"), (3, "elm", "b")], "id1 long, name string, county string")
    right = spark.createDataFrame([(10, "oak", "a")], "id2 long, name string, county string")
    passes = [linkage.Pass("exact", lambda a, b: linkage.exact(a, b, "name", ["county"], "id1", "id2")), linkage.Pass("never", None, condition=lambda a, b: False),
              linkage.Pass("near", lambda a, b: linkage.fuzzy(a, b, "name", ["county"], "id1", "id2"))]
    found = linkage.cascade(left, right, passes, "id1", "id2")
    assert {tuple(r) for r in found.matched.collect()} == {(1, 10, "exact"), (2, 10, "near")} and [r["id1"] for r in found.left.collect()] == [3]


def test_collapse(spark):
    rows = [(1, "x", "p,e"), (2, "x", "e,m"), (3, "x", "h"), (4, "x", "m"), (5, None, "e"), (6, " ", "e"), (7, "y", "h"), (8, "y", None), (9, "y", "p")]
    got = {r["id"]: r["new_id"] for r in linkage.collapse_places(spark.createDataFrame(rows, "id long, place_id string, level_code string"), "id").collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5, 6: 6, 7: 7, 8: 7, 9: 7}


def test_polygons_and_distances(spark):
    rng = random.Random(1)
    points = spark.createDataFrame([(i, rng.uniform(0, 3), rng.uniform(0, 3)) for i in range(200)], "id long, lat double, lon double")
    square = [{"lon": x, "lat": y} for x, y in ((0.5, 0.5), (2.0, 0.5), (2.0, 2.5), (0.5, 2.5))]
    polygons = spark.createDataFrame([("s", square)], "name string, ring array<struct<lon:double,lat:double>>")
    for r in places.in_polygon(points, polygons).collect():
        assert (r["name"] == "s") == (0.5 < r["lon"] < 2 and 0.5 < r["lat"] < 2.5)
    assert places.near_pairs(points.union(points), "id", "lat", "lon", 30_000).count() == places.near_pairs(points, "id", "lat", "lon", 30_000).count() > 0


def test_cache_and_patch(spark):
    asked = []

    def provider(batches):
        for b in batches:
            yield b.assign(place=b["name"] + "!")

    cache = spark.createDataFrame([("a", "old")], "name string, place string")
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "name string")
    known, answers = enrich.looked_up(df, ["name"], cache, provider, "name string, place string")
    assert {tuple(r) for r in answers.collect()} == {("a", "old"), ("b", "b!")} and known.count() == 2 and not asked
    fixed = enrich.patched(spark.createDataFrame([("a", None), ("b", "x")], "name string, place string"), known, "name", ["place"])
    assert {tuple(r) for r in fixed.collect()} == {("a", "old"), ("b", "x")}


def test_files_and_contracts(spark, tmp_path):
    sheet = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row><c r="A1" t="s"><v>0</v></c></row><row><c r="A2" t="s"><v>1</v></c><c r="C2" t="s"><v>2</v></c></row><row><c r="A3" t="inlineStr"><is><t>Oak</t></is></c><c r="C3"><v>12.7</v></c></row></sheetData></worksheet>'
    shared = '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t>note</t></si><si><t>School Name</t></si><si><t>K Total</t></si></sst>'
    book = io.BytesIO()
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("xl/sharedStrings.xml", shared)
    (tmp_path / "raw.xlsx").write_bytes(book.getvalue())
    df = files.read_sheet(spark, str(tmp_path / "raw.xlsx"), header="School Name")
    assert df.columns == ["school_name", "x2", "k_total"] and df.first()["school_name"] == "Oak"
    got = contract.Contract({"name": "string", "total": "int"}).apply(df, {"name": "school_name", "total": "k_total"}).first()
    assert tuple(got) == ("Oak", 12)
    with pytest.raises(ValueError, match="missing columns: x"):
        contract.Contract({"x": "int"}).apply(df)
    noted = contract.redacted(spark.createDataFrame([("**", "5"), ("<10", None)], "a string, b string")).collect()
    assert [tuple(r) for r in noted] == [(None, "5", "redacted"), (None, None, None)]
    page = spark.createDataFrame([('x gon.search = {"n": 3}; y',), ("none",)], "html string").select(files.embedded_json(F.col("html"), "gon.search", "n int").alias("j"))
    assert [r["j"] and r["j"]["n"] for r in page.collect()] == [3, None]


def test_cohort_weights(spark):
    df = spark.createDataFrame([("child", "MMR", "24 Months", 2023, 500, 0.9), ("teen", "MMR", "13-17 Years", 2023, 500, 0.9), ("school", "MMR", "Kindergarten", 2023, 500, 0.9), ("teen", "MMR PAC", "x", 2023, 5, 0.9)], "pop string, vaccine string, age_range string, year int, n int, p double")
    got = model_tables.spread_cohorts(model_tables.survey_rows(df)).groupBy("pop").agg(F.count("*"), F.round(F.sum("weight"), 6)).collect()
    assert {tuple(r) for r in got} == {("child", 2, 1.0), ("teen", 6, 1.0), ("school", 1, 1.0)}


def test_directory(spark):
    rows = [("1", "Old", 2015, 1, 1.0), ("1", "New", 2016, 1, None), ("2", "Gone", 2015, 1, 2.0), ("3", "Shut", 2016, 2, 2.0)]
    df = spark.createDataFrame(rows, "k string, name string, year int, status int, lat double").withColumn("lon", F.col("lat"))
    got = {r["k"]: (r["name"], r["names"], r["lat"], r["state"]) for r in rollups.directory_latest(df, "k", {1: "open", 2: "closed"}).collect()}
    assert got == {"1": ("New", ["New", "Old"], 1.0, "open"), "2": ("Gone", ["Gone"], 2.0, "closed"), "3": ("Shut", ["Shut"], 2.0, "closed")}


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_queries_equal_sql(spark, name):
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(str(tuple(r[c] for c in columns)) for r in df.collect())
    if name in catalogue.ORACLE:
        db = duckdb.connect()
        for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages", "documents"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        quoted = ", ".join(f'"{c}"' for c in columns)
        assert rows == sorted(str(r) for r in db.execute(f"SELECT {quoted} FROM ({catalogue.ORACLE[name]})").fetchall())
    else:
        assert rows


def test_finalize_conserves_rows(spark):
    from musterline.plans.finalize import finalize_series

    rows = [(1, 2022, 70, 60, 1, 2, "mmr"), (1, 2022, 80, 60, 1, 2, "mmr"), (2, 2022, 0, 1, 1, 1, "mmr"), (3, 2022, 70, 99, 1, 2, "mmr"), (4, 2022, 70, 69, 1, 2, "MMR2"), (None, 2022, 70, 60, 1, 2, "mmr")]
    df = spark.createDataFrame(rows, "school_id int, year int, enrollment int, current int, med_exempt int, rel_exempt int, vaccine_type string")
    out = finalize_series(df, "vaccine_type", ["Mmr"])["mmr"]
    assert out.cleaned.count() + out.excluded.count() == 5
    assert {(r["school_id"], r["sample_n"]) for r in out.observations.collect()} == {(1, 80)}
    with pytest.raises(ValueError, match="no series"):
        finalize_series(df, "vaccine_type", ["x"])


def test_survey_and_reports(spark):
    from musterline.operators import reports
    from musterline.sources import survey

    raw = spark.createDataFrame([("MMR", "Wisconsin", "Age", "24 Months", "2020", "90.0 ^", "205"), ("MMR", "Wisconsin", "Age", "24 Months", "2016-2019", "90", "5")], "vaccine string, geography string, dimension_type string, dimension string, birth_year string, estimate string, sample_size string")
    got = survey.household_survey(raw, "Wisconsin", "child", "birth_year", "birth").collect()
    assert [(r["year"], r["n"], r["p"], r["x"]) for r in got] == [(2020, 205.0, 0.9, 184.0)]
    df = spark.createDataFrame([(1, 2020, "closed_permanently", 1.0, "p", "1 Oak"), (1, 2021, "closed_permanently", 1.0, "p", "1 Oak"), (2, 2021, None, None, " ", "Oak")], "school_id int, year int, business_status string, lat double, place_id string, addr_clean string").withColumn("lon", F.col("lat")).withColumn("school_name", F.lit("x"))
    assert [(r["school_id"], r["year"], r["latest_year"]) for r in reports.closed_schools(df).orderBy("year").collect()] == [(1, 2020, 2021), (1, 2021, 2021)]
    assert [tuple(r)[-3:] for r in reports.missing_places(df).collect()] == [(True, True, True)]


def test_names_that_are_not_shared_match_nothing(spark):
    """Keys 5854 and 5820 once had names of one sound and like letters at one address, which the SQL of reference_key does not count."""
    from musterline.operators import reference

    side = lambda keys, tag, ending, new: roster_queries._roster(spark.createDataFrame([(k,) for k in keys], "k long"), F.col("k"), tag, ending).withColumnRenamed("__key", new)
    one, two = side([5820, 5832, 5854], "aa", "x", "data1_id"), side([5820], "zz", "y", "data2_id")
    step = next(p for p in reference.passes("data1_id", "data2_id") if p.name == "address")
    assert [tuple(r)[:2] for r in step.match(one, two).matched.collect()] == [(5820, 5820)]
