"""Rules, names, grades and addresses on small cases."""

from pyspark.sql import functions as F

from musterline.functions import address, grades, numeric, text
from musterline.operators import dqa


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


def test_names(spark):
    assert one(spark, "  The Lincoln  Elem. School & Arts ", text.school_name) == "lincoln elementary and arts"
    assert one(spark, "Mount Vernon E.S.", text.school_name) == "mt vernon elementary"
    assert one(spark, "St. Mary's County", text.county_name) == "st marys"
    assert one(spark, "Oak Unified School District", text.district_name) == "oak"
    assert [one(spark, x, text.school_level) for x in ("Oak Middle High", "High Road", "Oak High", "Kindergarten and nursery", "x")] == ["Middle/High", None, "High", "PreK/Elementary", None]
    assert [one(spark, x, text.school_type) for x in ("Non-Public", "public charter", "LEA", "", None)] == ["private", "charter", "public", None, None]
    assert [one(spark, x, text.is_po_box) for x in ("P.O. Box 3", "12 Oak", None)] == [True, False, False]


def test_grades(spark):
    assert [one(spark, x, grades.level_code) for x in ("PK-5", "6-6", "K-12", "x", None)] == ["p,e", "m,e", "e,m,h", None, None]
    assert [one(spark, x, grades.colon_grades) for x in ("KG:01:02", "XG", "", "12:PK", "05")] == ["k-2", None, None, "prek-12", "5"]
    assert one(spark, "Elementary/Middle", grades.level_code_of_type) == "e,m"
    assert [one(spark, x, grades.grade) for x in ("PK", "01", "n/a", "KG")] == ["prek", "1", None, "k"]


def test_addresses(spark):
    assert one(spark, "12 north First Street, Suite 4", address.clean_address) == "12 N 1ST STREET STE 4"
    assert one(spark, "12 Oak Avenue", address.clean_address) == "12 OAK AVE"
    assert one(spark, " ", address.clean_address) is None
    assert one(spark, "12 N Oak St APT 3", lambda c: address.clean_address(c, keep_units=False, keep_house_number=False, keep_directionals=False)) == "OAK ST"


def test_interval_statistics(spark):
    assert abs(numeric.t_quantile(0.975, 9) - 2.262157) < 1e-5 and abs(numeric.t_quantile(0.975, 1) - 12.7062) < 1e-3
    got = spark.createDataFrame([(1.0, 3.0, 10), (1.0, 2.0, 1)], "a double, b double, n int").select(numeric.sd_from_ci(F.col("a"), F.col("b"), F.col("n")).alias("sd")).collect()
    assert abs(got[0]["sd"] - 2 * 10**0.5 / (2 * 2.262157)) < 1e-5 and (got[1]["sd"] is None or got[1]["sd"] != got[1]["sd"])


def test_ledger_conserves_rows(spark):
    rows = [(1, 70, 60, 1, 2), (7, None, 60, 1, 2), (8, 0, 60, 1, 2), (9, 70, 99, 1, 2), (10, 70, 60, 80, 2), (11, 70, None, 1, 2), (12, 70, 0, 1, 2)]
    df = spark.createDataFrame(rows, "school_id int, enrollment int, current int, med_exempt int, rel_exempt int")
    got = {r["school_id"]: (r["exclusion_reason"], r["blanked"]) for r in dqa.ledger(df).collect()}
    assert got == {1: (None, None), 7: ("missing_enrollment", None), 8: ("zero_enrollment", None), 9: ("invalid_count", "current"),
                   10: ("invalid_count", "med_exempt, rel_exempt"), 11: ("missing_count", None), 12: ("zero_vaccinated", None)}
    assert dqa.ledger(df.limit(0)).count() == 0
