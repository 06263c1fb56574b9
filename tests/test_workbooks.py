"""Folders of workbooks read by tasks, reports as workbooks, and the sources that every state downloads."""

import zipfile

import pytest
from pyspark.sql import functions as F

from musterline.sources import directories, files


def test_folder_of_workbooks(spark, tmp_path):
    for i in range(20):
        names = ["School Name", f"K {i % 3}", *(["Extra"] if i == 19 else [])]
        rows = [["note"], names, *[[f"school {i} {n}", n, *(["e"] if i == 19 else [])] for n in range(1500 if i == 7 else 3)], [None, 1]]
        files.write_sheet(rows, str(tmp_path / f"b{i:02}.xlsx"))
    df = files.read_sheets(spark, str(tmp_path), header="school name")
    assert df.columns == ["file", "school_name", "k_0", "k_1", "k_2", "extra"]
    got = df.groupBy(F.regexp_extract("file", r"b(\d+)", 1).cast("int").alias("i")).agg(*[F.count(c).alias(c) for c in df.columns[1:]]).collect()
    assert {r["i"]: tuple(r)[1:] for r in got} == {i: ((n := 1500 if i == 7 else 3), *[n + 1 if i % 3 == k else 0 for k in range(3)], 3 if i == 19 else 0) for i in range(20)}
    assert df.where("school_name = 'school 7 1499'").first()["k_1"] == "1499"
    files.write_sheet([["nothing"]], str(tmp_path / "b99.xlsx"))
    with pytest.raises(ValueError, match="no header with 'school name' in the first column of .*b99"):
        files.read_sheets(spark, str(tmp_path), header="school name")


def test_second_sheet_and_repeated_names(spark, tmp_path):
    files.write_sheet([["A", "a", None], ["1", "2", "3"]], str(tmp_path / "x.xlsx"))
    assert [r.asDict() for r in files.read_sheet(spark, str(tmp_path / "x.xlsx")).collect()] == [{"a": "1", "a_2": "2", "x3": "3"}]
    with zipfile.ZipFile(tmp_path / "x.xlsx", "a") as book:
        book.writestr("xl/worksheets/sheet2.xml", book.read("xl/worksheets/sheet1.xml").decode().replace(">1<", ">7<"))
    assert files.read_sheet(spark, str(tmp_path / "x.xlsx")).first()["a"] == "7" and files.read_sheet(spark, str(tmp_path / "x.xlsx"), sheet=1).first()["a"] == "1"


def test_report_as_a_workbook(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "r.xlsx")
    files.write_report(spark.range(0, 3000, 1, 4).withColumn("text", F.concat(F.lit("<&> "), "id")), path, "xlsx")
    got = files.read_sheet(spark, path)
    assert got.columns == ["id", "text"] and got.count() == 3000 and got.where("id = '2999'").first()["text"] == "<&> 2999"
    files.write_report(spark.range(0), path, "xlsx")
    assert files.read_sheet(spark, path).count() == 0
    monkeypatch.setattr(files, "MOST_ROWS", 3)
    with pytest.raises(ValueError, match="at most 3 rows"):
        files.write_report(spark.range(3), path, "xlsx")


def test_sources_of_a_state(spark, tmp_path):
    asked = tmp_path / "asked"

    def fetch(z, page):
        with open(asked, "a") as log:
            log.write(f"{z} {page}\n")
        return (200, f'gon.search={{"schools":[{{"id":"{z}","state":"MD","schoolType":"LEA","address":{{"zip":"{z}"}}}}]}};') if page == 1 else (404, "")

    zips = spark.createDataFrame([("20001", "x", 0.9, "MD"), ("20002", "y", 0.9, "MD"), ("30001", "z", 0.9, "WI")], "zip string, county string, ratio double, state string")
    home = spark.createDataFrame([("MMR", "Maryland", "Age", "24 Months", "2020", "90.5", "100", "88.0 to 92.0")], "vaccine string, geography string, dimension_type string, dimension string, birth_year string, estimate string, sample_size string, ci string")
    school = spark.createDataFrame([("MMR", "Ohio", "2020-21", "90", "10", "50")], "vaccine string, geography string, school_year string, estimate string, population string, surveyed string")
    surveys = (home, school, home.withColumnRenamed("birth_year", "survey_year"))
    schools, coverage = directories.state_sources(spark, "md", "Maryland", zips, zips, fetch, surveys, str(tmp_path / "s"), str(tmp_path / "v"))
    assert sorted((r["id"], r["county"], r["schoolType"]) for r in schools.collect()) == [("20001", "x", "public"), ("20002", "y", "public")]
    assert sorted((r["pop"], r["year"], r["p"]) for r in coverage.collect()) == [("child", 2020, 0.905), ("teen", 2020, 0.905)]
    assert spark.read.csv(str(tmp_path / "s" / "schools.csv"), header=True).count() == 2 and spark.read.parquet(str(tmp_path / "v" / "vax_view.parquet")).count() == 2
    assert sorted(asked.read_text().split("\n")[:-1]) == ["20001 1", "20001 2", "20002 1", "20002 2"]
