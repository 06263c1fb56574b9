"""Registered queries over the driver's tables, and the SQL that states the same results."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import address, grades, similarity, text
from ..operators import audit, dqa, linkage, places, reports, rollups, rosters
from ..operators.service import durable
from ..sources import cleaners
from . import costs, finalize, model_tables, standardize

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function (spark, sf_dir) under ``name``, with its SQL if there is one."""

    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def school_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A school-year table made of line items: school_id, year, enrollment, current, med_exempt, rel_exempt."""
    q, line = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    factor = F.when(F.col("l_returnflag") == "A", 12).when(F.col("l_returnflag") == "N", 9).otherwise(0)
    grouped = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("school_id"), F.year("l_shipdate").alias("year"))
    return grouped.agg(
        F.sum(q).cast("int").alias("enrollment"), F.floor(F.sum(q * factor) / 10.0).cast("int").alias("current"),
        (F.sum(F.when(F.col("l_linestatus") == "F", line).otherwise(0)).cast("int") - 2).alias("med_exempt"),
        F.when(F.sum(line) % 11 != 0, F.sum(line)).cast("int").alias("rel_exempt"),
    )


SY = """
SELECT l_partkey AS school_id, CAST(year(l_shipdate) AS INT) AS year, CAST(sum(CAST(l_quantity AS INT)) AS INT) AS enrollment,
  CAST(floor(sum(CAST(l_quantity AS INT) * CASE l_returnflag WHEN 'A' THEN 12 WHEN 'N' THEN 9 ELSE 0 END) / 10.0) AS INT) AS current,
  CAST(CAST(sum(CASE WHEN l_linestatus = 'F' THEN l_linenumber ELSE 0 END) AS INT) - 2 AS INT) AS med_exempt,
  CASE WHEN sum(l_linenumber) % 11 = 0 THEN NULL ELSE CAST(sum(l_linenumber) AS INT) END AS rel_exempt
FROM lineitem GROUP BY l_partkey, year(l_shipdate)
"""
WITH_SY = f"WITH sy AS ({SY}) "


def shifted(df: DataFrame) -> DataFrame:
    return df.withColumn("enrollment", F.col("enrollment") - 20)


RULE_SQL = {
    "zero_enrollment": "enrollment IS NULL OR enrollment <= 0",
    "zero_current": "current IS NULL OR current = 0",
    "negative": "least(enrollment, current, med_exempt, rel_exempt) < 0",
    "too_high": "greatest(current, med_exempt, rel_exempt) > enrollment",
    "coverage_outlier": "enrollment <> 0 AND (current * 1.0 / enrollment < 0 OR current * 1.0 / enrollment > 1.05)",
    "over_coverage": "current + med_exempt + rel_exempt > enrollment",
}
for _rule in RULE_SQL:
    _base = f"(SELECT * REPLACE (enrollment - 20 AS enrollment) FROM ({SY}))" if _rule == "zero_enrollment" else f"({SY})"

    @query(f"dqa_{_rule}", f"SELECT * FROM {_base} WHERE {RULE_SQL[_rule]}")
    def _by_rule(spark, sf_dir, rule=_rule):
        df = school_years(spark, sf_dir)
        return dqa.broken(shifted(df) if rule == "zero_enrollment" else df, next(r for r in dqa.row_rules() if r.name == rule))


@query("dqa_summary", WITH_SY + " UNION ALL ".join(f"SELECT '{k}' AS \"check\", CAST(count(*) FILTER (WHERE {v}) AS BIGINT) AS issue_count FROM sy" for k, v in RULE_SQL.items()))
def dqa_summary(spark, sf_dir):
    return dqa.summary(school_years(spark, sf_dir), dqa.row_rules())


def _deviation_sql(column: str, threshold: float) -> str:
    return WITH_SY + f""", m AS (SELECT *, avg({column}) OVER (PARTITION BY school_id) AS mean FROM sy)
    SELECT school_id, year, {column}, round(mean, 6) AS mean, round(abs({column} - mean) / mean, 6) AS deviation FROM m WHERE mean <> 0 AND abs({column} - mean) / mean > {threshold}"""


def _deviation(spark, sf_dir, column, threshold):
    found = dqa.deviation(school_years(spark, sf_dir), column, threshold)
    return found.select("school_id", "year", column, F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation"))


@query("dqa_enrollment_deviation", _deviation_sql("enrollment", 1.0))
def dqa_enrollment_deviation(spark, sf_dir):
    return _deviation(spark, sf_dir, "enrollment", 1.0)


@query("dqa_current_deviation", _deviation_sql("current", 0.75))
def dqa_current_deviation(spark, sf_dir):
    return _deviation(spark, sf_dir, "current", 0.75)


@query("dqa_deviation_history", WITH_SY + """, m AS (SELECT *, avg(enrollment) OVER (PARTITION BY school_id) AS mean FROM sy)
SELECT * FROM sy WHERE school_id IN (SELECT school_id FROM m WHERE mean <> 0 AND abs(enrollment - mean) / mean > 1.0)""")
def dqa_deviation_history(spark, sf_dir):
    df = school_years(spark, sf_dir)
    return dqa.with_history(df, dqa.deviation(df, "enrollment", 1.0))


@query("dqa_extreme_outliers", WITH_SY + """, m AS (SELECT *, median(enrollment) OVER (PARTITION BY school_id) AS med FROM sy)
SELECT school_id, year, enrollment, round(enrollment / med, 6) AS ratio, CASE WHEN enrollment / med >= 10 THEN 'high' ELSE 'low' END AS outlier_type
FROM m WHERE med > 0 AND (enrollment / med >= 10 OR enrollment / med <= 1 / 10.0)""")
def dqa_extreme_outliers(spark, sf_dir):
    return dqa.extreme(school_years(spark, sf_dir)).select("school_id", "year", "enrollment", F.round("ratio", 6).alias("ratio"), "outlier_type")


@query("dqa_duplicates", """SELECT l_partkey AS school_id, CAST(year(l_shipdate) AS INT) AS year, count(*) AS n_rows,
count(DISTINCT row(l_quantity, l_returnflag)) = 1 AS identical FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def dqa_duplicates(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("school_id"), F.year("l_shipdate").alias("year"), "l_quantity", "l_returnflag")
    return dqa.duplicates(rows)


@query("dedupe_max_enrollment", """SELECT school_id, year, enrollment, l_orderkey, l_linenumber FROM (
SELECT l_partkey AS school_id, CAST(year(l_shipdate) AS INT) AS year, CAST(l_quantity AS INT) AS enrollment, l_orderkey, l_linenumber,
row_number() OVER (PARTITION BY l_partkey, year(l_shipdate) ORDER BY CAST(l_quantity AS INT) DESC, l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n = 1""")
def dedupe_max_enrollment(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("school_id"), F.year("l_shipdate").alias("year"), F.col("l_quantity").cast("int").alias("enrollment"), "l_orderkey", "l_linenumber")
    return dqa.largest_first(rows, ties=("l_orderkey", "l_linenumber"))


_PARTS = "coalesce(med_exempt > enrollment, false) OR coalesce(rel_exempt > enrollment, false) OR coalesce(med_exempt + rel_exempt > enrollment, false)"
_FIXED = f"""SELECT school_id, year, enrollment, CASE WHEN current < 0 OR current > enrollment THEN NULL ELSE current END AS current,
CASE WHEN {_PARTS} THEN NULL ELSE med_exempt END AS med_exempt, CASE WHEN {_PARTS} THEN NULL ELSE rel_exempt END AS rel_exempt,
nullif(concat_ws('; ', CASE WHEN current < 0 THEN 'current <0' END, CASE WHEN current > enrollment THEN 'current > enrollment' END, CASE WHEN {_PARTS} THEN 'exemptions > enrollment' END), '') AS excluded_note FROM sy"""


@query("dqa_fix_invalid", WITH_SY + _FIXED)
def dqa_fix_invalid(spark, sf_dir):
    return dqa.blank_invalid(school_years(spark, sf_dir))


@query("dqa_cap_current", WITH_SY + "SELECT * REPLACE (CASE WHEN current > enrollment - med_exempt - rel_exempt THEN enrollment - med_exempt - rel_exempt ELSE current END AS current) FROM sy")
def dqa_cap_current(spark, sf_dir):
    return dqa.cap_current(school_years(spark, sf_dir))


@query("exclusion_ledger", f"WITH sy AS (SELECT * REPLACE (enrollment - 20 AS enrollment) FROM ({SY})), f AS ({_FIXED}), " + """b AS (
SELECT sy.*, f.current AS c2, f.med_exempt AS m2, f.rel_exempt AS r2,
nullif(concat_ws(', ', CASE WHEN sy.current IS NOT NULL AND f.current IS NULL THEN 'current' END, CASE WHEN sy.med_exempt IS NOT NULL AND f.med_exempt IS NULL THEN 'med_exempt' END, CASE WHEN sy.rel_exempt IS NOT NULL AND f.rel_exempt IS NULL THEN 'rel_exempt' END), '') AS lost
FROM sy JOIN f USING (school_id, year))
SELECT school_id, year, enrollment, current, med_exempt, rel_exempt, CASE WHEN enrollment > 0 THEN lost END AS blanked,
CASE WHEN enrollment <= 0 THEN 'zero_enrollment' WHEN (c2 IS NULL OR m2 IS NULL OR r2 IS NULL) AND lost IS NOT NULL THEN 'invalid_count'
WHEN c2 IS NULL OR m2 IS NULL OR r2 IS NULL THEN 'missing_count' WHEN c2 = 0 THEN 'zero_vaccinated' END AS exclusion_reason FROM b""")
def exclusion_ledger(spark, sf_dir):
    return dqa.ledger(shifted(school_years(spark, sf_dir)))


@query("std_county", r"""SELECT c_custkey, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(regexp_replace(c_mktsegment || ' County-' || c_name, '\s+', ' ', 'g'))), 'county', '', 'g'), '[/.-]', ' ', 'g'), '\pP', '', 'g'), '\s+', ' ', 'g')) AS county FROM customer""")
def std_county(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", text.county_name(F.concat("c_mktsegment", F.lit(" County-"), "c_name")).alias("county"))


def _concat_query(name: str, table_name: str, key: str, source, f, alias: str, sql: str):
    @query(name, sql)
    def run(spark, sf_dir):
        return table(spark, sf_dir, table_name).select(key, f(source()).alias(alias))


_concat_query("std_name", "part", "p_partkey", lambda: F.concat(F.lit("The "), "p_name", F.lit("  Elem. School & Arts")), text.school_name, "name",
              "SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) || ' elementary and arts' AS name FROM part")
_concat_query("std_district", "supplier", "s_suppkey", lambda: F.concat(F.lit("Unit "), F.col("s_suppkey").cast("string"), F.lit(" Unified School District &amp; Co.")), text.district_name, "district",
              "SELECT s_suppkey, 'unit ' || s_suppkey || ' and co' AS district FROM supplier")
_concat_query("clean_address", "supplier", "s_suppkey", lambda: F.concat(F.col("s_suppkey").cast("string"), F.lit(" North Second Oak, Suite "), F.col("s_nationkey").cast("string"), F.lit(" # 7 Hill Avenue")), address.clean_address, "address",
              "SELECT s_suppkey, s_suppkey || ' N 2ND OAK STE ' || s_nationkey || ' APT 7 HILL AVE' AS address FROM supplier")


def name_pairs(spark, sf_dir):
    """Pairs of different part names of one brand."""
    names = table(spark, sf_dir, "part").select("p_brand", "p_name").distinct()
    other = names.withColumnRenamed("p_name", "q_name")
    return names.join(other, "p_brand").where("p_name < q_name").select("p_name", "q_name").distinct()


_PAIRS = """WITH n AS (SELECT DISTINCT p_brand, p_name FROM part),
p AS (SELECT DISTINCT a.p_name, b.p_name AS q_name FROM n a JOIN n b ON a.p_brand = b.p_brand AND a.p_name < b.p_name),
c AS (SELECT s, ch, count(*) AS n FROM (SELECT p_name AS s, unnest(string_split(p_name, '')) AS ch FROM (SELECT DISTINCT p_name FROM part)) GROUP BY s, ch),
u AS (SELECT p_name, q_name, sum(x) AS dot, sum(least(x, y)) AS low, sum(greatest(x, y)) AS high, sum(abs(x - y)) AS gap, sqrt(sum(x * x)) * sqrt(sum(y * y)) AS norm, sum(x * y) AS xy FROM (
  SELECT p.p_name, p.q_name, k.ch, coalesce(a.n, 0) AS x, coalesce(b.n, 0) AS y FROM p JOIN (SELECT DISTINCT s, ch FROM c) k ON k.s = p.p_name OR k.s = p.q_name
  LEFT JOIN c a ON a.s = p.p_name AND a.ch = k.ch LEFT JOIN c b ON b.s = p.q_name AND b.ch = k.ch GROUP BY ALL) GROUP BY p_name, q_name) """
for _name, _f, _sql in (("sim_cosine", similarity.cosine, "greatest(0, 1 - xy / norm)"), ("sim_qgram", similarity.qgram, "gap"), ("sim_jaccard", similarity.jaccard, "1 - low / high")):

    @query(_name, _PAIRS + f"SELECT p_name, q_name, round(CAST({_sql} AS DOUBLE), 6) AS distance FROM u")
    def _by_measure(spark, sf_dir, f=_f):
        return name_pairs(spark, sf_dir).select("p_name", "q_name", F.round(f(F.col("p_name"), F.col("q_name")), 6).alias("distance"))


def _rosters(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id1"), (F.col("c_custkey") % 500).cast("string").alias("name"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_nationkey").cast("string")).alias("county"), (F.col("c_custkey") % 7).cast("string").alias("zip"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id2"), (F.col("s_suppkey") % 500).cast("string").alias("name"), F.col("s_nationkey").cast("string").alias("county"), (F.col("s_suppkey") % 5).cast("string").alias("zip"))
    return c, s


_ROSTERS = """WITH c AS (SELECT c_custkey AS id1, CAST(c_custkey % 500 AS VARCHAR) AS name, CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS county, CAST(c_custkey % 7 AS VARCHAR) AS zip FROM customer),
s AS (SELECT s_suppkey AS id2, CAST(s_suppkey % 500 AS VARCHAR) AS name, CAST(s_nationkey AS VARCHAR) AS county, CAST(s_suppkey % 5 AS VARCHAR) AS zip FROM supplier), """
_ONE_TO_ONE = """a AS (SELECT *, row_number() OVER (PARTITION BY id1 ORDER BY turn, id2) AS k FROM p), b AS (SELECT *, row_number() OVER (PARTITION BY id2 ORDER BY turn, id1) AS m FROM a WHERE k = 1)
SELECT id1 AS orig_id_1, id2 AS orig_id_2 FROM b WHERE m = 1"""


@query("exact_match_any", _ROSTERS + "p AS (SELECT id1, id2, CASE WHEN c.county = s.county THEN 0 WHEN c.zip = s.zip THEN 1 END AS turn FROM c JOIN s USING (name) WHERE c.county = s.county OR c.zip = s.zip), " + _ONE_TO_ONE)
def exact_match_any(spark, sf_dir):
    return linkage.exact(*_rosters(spark, sf_dir), "name", ["county", "zip"], "id1", "id2").matched


@query("exact_match_all", _ROSTERS + "p AS (SELECT id1, id2, 0 AS turn FROM c JOIN s USING (name) WHERE (c.county IS NULL OR c.county = s.county) AND c.zip = s.zip), " + _ONE_TO_ONE)
def exact_match_all(spark, sf_dir):
    return linkage.exact(*_rosters(spark, sf_dir), "name", ["county", "zip"], "id1", "id2", "all").matched


@query("place_join", _ROSTERS + "o AS (SELECT county, min(id2) AS id2 FROM s GROUP BY county) SELECT id1 AS orig_id_1, id2 AS orig_id_2, CAST(1 AS DOUBLE) AS match_score, 'Exact Match (county)' AS match_category FROM c JOIN o USING (county)")
def place_join(spark, sf_dir):
    return linkage.by_key(*_rosters(spark, sf_dir), "county", "id1", "id2").matched


@query("left_anti_unmatched", _ROSTERS + "x AS (SELECT 1) SELECT id1, name, county, zip FROM c WHERE county IS NULL OR county NOT IN (SELECT county FROM s)")
def left_anti_unmatched(spark, sf_dir):
    return linkage.by_key(*_rosters(spark, sf_dir), "county", "id1", "id2").left


def _names(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id1"), F.col("p_name").alias("name"), F.col("p_brand").alias("county"))
    typo = F.concat(F.substring("p_name", 1, 3), F.lit("x"), F.substring("p_name", 5, 100))
    q = table(spark, sf_dir, "part").groupBy("p_brand", "p_name").agg(F.min("p_partkey").alias("id2")).select("id2", F.when(F.col("id2") % 3 == 0, typo).otherwise(F.col("p_name")).alias("name"), F.col("p_brand").alias("county"))
    return p, q


def _points(spark, sf_dir):
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(s.alias("id"), (40 + (s * 37 % 101) / 20000.0).alias("lat"), (-80 + (s * 53 % 89) / 20000.0).alias("lon"))


_POINTS = """WITH p AS (SELECT s_suppkey AS id, 40 + (s_suppkey * 37 % 101) / 20000.0 AS lat, -80 + (s_suppkey * 53 % 89) / 20000.0 AS lon FROM supplier),
d AS (SELECT a.id AS id_1, b.id AS id_2, 2 * 6371000.0 * asin(least(1.0, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) AS m FROM p a JOIN p b ON a.id < b.id) """


@query("near_duplicates_50m", _POINTS + "SELECT id_1, id_2, round(m, 1) AS distance_m FROM d WHERE m > 0 AND m <= 50")
def near_duplicates_50m(spark, sf_dir):
    return places.near_pairs(_points(spark, sf_dir), "id", "lat", "lon")


@query("range_geo_join", _POINTS + "SELECT id_1, id_2, CAST(round(m) AS BIGINT) AS metres FROM d WHERE m <= 120")
def range_geo_join(spark, sf_dir):
    p = _points(spark, sf_dir)
    side = lambda k: p.select(*[F.col(c).alias(f"{k}_{c}") for c in p.columns])
    return places.within(side("l"), side("r"), 120).where("l_id < r_id").select(F.col("l_id").alias("id_1"), F.col("r_id").alias("id_2"), F.round("distance_m").cast("long").alias("metres"))


@query("modal_value", """SELECT o_custkey, o_orderpriority FROM (SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS k FROM orders GROUP BY 1, 2) WHERE k = 1""")
def modal_value(spark, sf_dir):
    return rollups.modal(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority")


@query("majority_type", """SELECT o_custkey, o_orderstatus FROM (SELECT o_custkey, o_orderstatus, count(*) AS n, sum(count(*)) OVER (PARTITION BY o_custkey) AS t FROM orders GROUP BY 1, 2) WHERE n > 0.5 * t""")
def majority_type(spark, sf_dir):
    return rollups.majority(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderstatus")


@query("packed_ids", "SELECT s_nationkey, string_agg(DISTINCT s_name, '; ' ORDER BY s_name) AS packed, count(*) AS n_records FROM supplier GROUP BY 1")
def packed_ids(spark, sf_dir):
    return rollups.packed(table(spark, sf_dir, "supplier"), ["s_nationkey"], "s_name")


@query("explode_ids", "SELECT DISTINCT s_nationkey, s_name AS packed FROM supplier")
def explode_ids(spark, sf_dir):
    return rollups.unpacked(packed_ids(spark, sf_dir).drop("n_records"), "packed")


@query("years_by_school", WITH_SY + "SELECT school_id, " + ", ".join(f'count(*) FILTER (WHERE year = {y}) AS "{y}"' for y in range(1992, 1999)) + ", CAST(count(DISTINCT year) FILTER (WHERE year BETWEEN 1992 AND 1998) AS INT) AS n_years FROM sy GROUP BY school_id")
def years_by_school(spark, sf_dir):
    return rollups.years_wide(school_years(spark, sf_dir), "school_id", list(range(1992, 1999)))


@query("missing_years", WITH_SY + ", s AS (SELECT school_id, unnest(generate_series(min(year), max(year))) AS year FROM sy GROUP BY 1) SELECT school_id, CAST(year AS INT) AS year FROM s ANTI JOIN sy USING (school_id, year)")
def missing_years(spark, sf_dir):
    return rollups.missing_years(school_years(spark, sf_dir), "school_id")


_LONG = " UNION ALL ".join(f"SELECT school_id, year, '{c}' AS metric, {c} AS value FROM sy" for c in ("enrollment", "current", "med_exempt", "rel_exempt"))


@query("wide_to_long", WITH_SY + _LONG)
def wide_to_long(spark, sf_dir):
    return school_years(spark, sf_dir).unpivot(["school_id", "year"], ["enrollment", "current", "med_exempt", "rel_exempt"], "metric", "value")


@query("distribution_profile", WITH_SY + f"""SELECT metric AS "column", count(*) AS n, count(*) FILTER (WHERE value IS NULL) AS n_missing, count(*) FILTER (WHERE value < 0) AS n_negative, count(*) FILTER (WHERE value = 0) AS n_zero,
CAST(min(value) AS DOUBLE) AS low, quantile_cont(value, 0.25) AS p25, median(value) AS mid, round(avg(value), 6) AS average, quantile_cont(value, 0.75) AS p75, CAST(max(value) AS DOUBLE) AS high FROM ({_LONG}) GROUP BY 1""")
def distribution_profile(spark, sf_dir):
    return rollups.profile(school_years(spark, sf_dir), ["enrollment", "current", "med_exempt", "rel_exempt"])


@query("api_cost", """WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1) SELECT event_type, n AS requests, greatest(300 + n - 500, 0) - greatest(300 - 500, 0) AS billable, round((greatest(300 + n - 500, 0) - greatest(300 - 500, 0)) * 5.0 / 1000, 6) AS cost FROM c""")
def api_cost(spark, sf_dir):
    calls = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("requests"))
    return calls.withColumn("billable", rollups.billable(F.col("requests"), F.lit(300), F.lit(500)).cast("long")).withColumn("cost", F.round(F.col("billable") * 5.0 / 1000, 6))


def _survey(spark, sf_dir):
    k = F.col("c_custkey")
    pick = lambda values, by: F.element_at(F.array(*map(F.lit, values)), (by % len(values)).cast("int") + 1)
    return table(spark, sf_dir, "customer").select(
        k.alias("row_id"), pick(["child", "teen", "school"], k).alias("pop"), pick(["MMR", "DTaP", "MMR, PAC", "1+ MMR"], k).alias("vaccine"), pick(["24 Months", "35 Months", "19 Months", "13-17 Years", "Kindergarten"], k).alias("age_range"),
        (2010 + k % 12).cast("int").alias("year"), F.when(k % 11 != 0, 100 + k % 50).cast("int").alias("n"), ((k % 90) / 100.0).alias("p"))


_SURVEY = """WITH v AS (SELECT c_custkey AS row_id, ['child', 'teen', 'school'][c_custkey % 3 + 1] AS pop, ['MMR', 'DTaP', 'MMR, PAC', '1+ MMR'][c_custkey % 4 + 1] AS vaccine,
['24 Months', '35 Months', '19 Months', '13-17 Years', 'Kindergarten'][c_custkey % 5 + 1] AS age_range, CAST(2010 + c_custkey % 12 AS INT) AS year, CAST(CASE WHEN c_custkey % 11 <> 0 THEN 100 + c_custkey % 50 END AS INT) AS n, CAST((c_custkey % 90) / 100.0 AS DOUBLE) AS p FROM customer),
f AS (SELECT * FROM v WHERE vaccine ILIKE '%mmr%' AND vaccine NOT ILIKE '%pac%' AND age_range NOT IN ('13 Months', '19 Months') AND n IS NOT NULL AND p IS NOT NULL) """
_COHORT_ROWS = ", ".join(f"('{k}', {o}, {w}, {model_tables.DOSES[k]})" for k, v in model_tables.COHORTS.items() for o, w in v)


@query("vaxview_expand", _SURVEY + f"""SELECT row_id, f.pop, vaccine, age_range, year, n, p, CAST(year + o AS INT) AS cohort, CAST(CASE WHEN age_range = '24 Months' THEN 2 WHEN age_range = '35 Months' THEN 3 WHEN f.pop = 'school' THEN 5 WHEN f.pop = 'teen' THEN -o - 1 END AS INT) AS life_year,
CAST(w AS DOUBLE) AS weight, CAST(dose AS INT) AS dose FROM f JOIN (VALUES {_COHORT_ROWS}) AS t(pop, o, w, dose) ON f.pop = t.pop""")
def vaxview_expand(spark, sf_dir):
    return model_tables.spread_cohorts(model_tables.survey_rows(_survey(spark, sf_dir)))


@query("vaxview_stats", _SURVEY + "SELECT row_id, round_even(p * n, 0) AS x, round(sqrt(p * (1 - p)), 6) AS sd, round(sqrt(p * (1 - p) / n), 6) AS se FROM f")
def vaxview_stats(spark, sf_dir):
    return model_tables.statistics(model_tables.survey_rows(_survey(spark, sf_dir))).select("row_id", "x", F.round("sd", 6).alias("sd"), F.round("se", 6).alias("se"))


@query("locations_tree", """WITH l AS (SELECT r_name AS st, n_name AS co, s_suppkey AS id FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT DISTINCT st AS loc_id, NULL AS parent_id, 'state' AS level FROM l UNION ALL SELECT DISTINCT st || '/' || co, st, 'county' FROM l UNION ALL SELECT DISTINCT st || '/' || co || '/' || id, st || '/' || co, 'school' FROM l""")
def locations_tree(spark, sf_dir):
    joined = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return model_tables.location_tree(joined.select(F.col("r_name").alias("state"), F.col("n_name").alias("county"), F.col("s_suppkey").alias("school_id")))


@query("linkage_key", WITH_SY + "SELECT school_id || '-' || year AS obs_id, school_id, year, current AS positive, enrollment AS sample_n, year - 5 AS cohort, 5 AS age, 2 AS dose, CAST(1 AS DOUBLE) AS weight FROM sy")
def linkage_key(spark, sf_dir):
    return model_tables.observations(school_years(spark, sf_dir))


@query("finalize_cleaned", WITH_SY + f""", f AS ({_FIXED}) SELECT school_id, year, enrollment, current, med_exempt, rel_exempt FROM f
WHERE enrollment > 0 AND current IS NOT NULL AND med_exempt IS NOT NULL AND rel_exempt IS NOT NULL AND current <> 0""")
def finalize_cleaned(spark, sf_dir):
    return finalize.finalize(school_years(spark, sf_dir)).cleaned


_SERIES = "s AS (SELECT *, CASE school_id % 3 WHEN 0 THEN 'mmr' WHEN 1 THEN 'polio' END AS series FROM sy)"


@query("written_series", WITH_SY + f""", {_SERIES}, r AS (SELECT *, CASE WHEN enrollment IS NULL THEN 'missing_enrollment' WHEN enrollment <= 0 THEN 'zero_enrollment' END AS early FROM s WHERE series IS NOT NULL)
SELECT series, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(early) AS BIGINT) AS n_without_enrollment FROM r GROUP BY series""")
def written_series(spark, sf_dir):
    """Rows of the written clean and excluded tables of each series, read back through the manifest."""
    durable(spark)
    kind = F.when(F.col("school_id") % 3 == 0, " MMR").when(F.col("school_id") % 3 == 1, "Polio")
    folder = f"{spark.sparkContext.getCheckpointDir()}/final-{uuid.uuid4().hex}"
    lines = finalize.write_final(school_years(spark, sf_dir).withColumn("kind", kind), "kind", folder)
    both = [finalize.read_final(spark, folder, r["table"], r["series"]).select("series", *([F.col("exclusion_reason")] if r["table"] == "excluded" else [F.lit(None).cast("string").alias("exclusion_reason")])) for r in lines.where("table in ('cleaned', 'excluded')").collect()]
    early = F.col("exclusion_reason").isin("missing_enrollment", "zero_enrollment")
    return reduce(DataFrame.union, both).groupBy("series").agg(F.count("*").alias("n_rows"), F.count(F.when(early, 1)).alias("n_without_enrollment"))


@query("call_summary", """WITH c AS (SELECT event_type AS api, CASE WHEN event_id % 7 = 0 THEN 'E' || event_id % 3 END AS code, 1 AS n FROM events),
k AS (SELECT api, code, sum(n) AS n FROM c WHERE code IS NOT NULL GROUP BY 1, 2), s AS (SELECT api, string_agg(code || ': ' || CAST(n AS BIGINT), '; ' ORDER BY n DESC, code) AS failures FROM k GROUP BY 1)
SELECT c.api, count(*) AS requests, count(*) FILTER (WHERE code IS NULL) AS succeeded, count(*) FILTER (WHERE code IS NOT NULL) AS failed, round(count(*) * 5.0 / 1000, 6) AS cost, any_value(failures) AS failures FROM c LEFT JOIN s USING (api) GROUP BY c.api""")
def call_summary(spark, sf_dir):
    calls = table(spark, sf_dir, "events").select(F.col("event_type").alias("api"), F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("E"), (F.col("event_id") % 3).cast("string"))).alias("code"), F.lit(1).alias("requests"))
    prices = calls.select("api").distinct().withColumn("usd_per_1000", F.lit(5.0))
    return reports.call_summary(calls, prices).withColumn("cost", F.round("cost", 6))


_DELAYED = "SELECT *, CASE WHEN enrollment - current - med_exempt - rel_exempt < 0 THEN 0 ELSE enrollment - current - med_exempt - rel_exempt END AS delayed FROM sy"
_AUDIT_SQL = {
    "duplicates_conflicting": "false", "negative_values": "least(current, delayed, med_exempt, rel_exempt, enrollment) < 0", "exceeding_enrollment": "greatest(current, delayed, med_exempt, rel_exempt) > enrollment",
    "coverage_outliers": "enrollment <> 0 AND (current * 1.0 / enrollment < 0 OR current * 1.0 / enrollment > 1.05)", "over_coverage": "current + delayed + med_exempt + rel_exempt > enrollment",
    "enrollment_deviation": "me <> 0 AND abs(enrollment - me) / me > 0.5", "vaccination_deviation": "(mc <> 0 AND abs(current - mc) / mc > 0.5) OR (mc = 0 AND current <> 0)", "extreme_outliers": "enrollment > 10 * md",
}


@query("audit_summary", WITH_SY + f", d AS ({_DELAYED}), a AS (SELECT *, avg(enrollment) OVER w AS me, avg(current) OVER w AS mc, median(enrollment) OVER w AS md FROM d WINDOW w AS (PARTITION BY school_id)) "
       + " UNION ALL ".join(f"SELECT '{k}' AS \"check\", count(*) FILTER (WHERE {v}) AS issue_count, 'requires_review' AS action_type FROM a" for k, v in _AUDIT_SQL.items()))
def audit_summary(spark, sf_dir):
    room = F.col("enrollment") - F.col("current") - F.col("med_exempt") - F.col("rel_exempt")
    df = school_years(spark, sf_dir).withColumn("delayed", F.when(room < 0, 0).otherwise(room))
    return audit.run_checks(df).summary


_REPEATED = f"""r AS (SELECT * FROM ({_DELAYED}) UNION ALL SELECT * FROM ({_DELAYED}) WHERE school_id % 3 = 0 UNION ALL SELECT * REPLACE (current + 1 AS current) FROM ({_DELAYED}) WHERE school_id % 5 = 0),
d AS (SELECT DISTINCT * FROM r), k AS (SELECT school_id, year FROM d GROUP BY ALL HAVING count(*) > 1)"""


@query("audit_of_repeats", WITH_SY + f", {_REPEATED}, a AS (SELECT *, avg(enrollment) OVER w AS me, avg(current) OVER w AS mc, median(enrollment) OVER w AS md FROM d WINDOW w AS (PARTITION BY school_id)) "
       + " UNION ALL ".join(f"SELECT '{k}' AS \"check\", count(*) FILTER (WHERE {v}) AS issue_count, 'requires_review' AS action_type FROM a" for k, v in _AUDIT_SQL.items() if v != "false")
       + " UNION ALL SELECT 'duplicates_conflicting', count(*), 'requires_review' FROM r SEMI JOIN k USING (school_id, year)")
def audit_of_repeats(spark, sf_dir):
    """The audit where a third of the schools stand twice, and a fifth again with another count."""
    room = F.col("enrollment") - F.col("current") - F.col("med_exempt") - F.col("rel_exempt")
    df = school_years(spark, sf_dir).withColumn("delayed", F.when(room < 0, 0).otherwise(room))
    other = df.where("school_id % 5 = 0").withColumn("current", F.col("current") + 1)
    return audit.run_checks(df.union(df.where("school_id % 3 = 0")).union(other)).summary


@query("county_slips", """WITH r AS (SELECT CAST(o_custkey AS VARCHAR) AS name, CASE WHEN o_custkey % 3 = 0 AND year(o_orderdate) >= 1997 THEN 'x' WHEN o_custkey % 3 = 1 AND o_orderpriority = '1-URGENT' THEN 'x' ELSE 'y' END AS county, year(o_orderdate) AS y FROM orders),
t AS (SELECT name, county, count(*) AS n, list(DISTINCT y) AS years FROM r GROUP BY 1, 2), k AS (SELECT *, max(n) OVER (PARTITION BY name) AS top, row_number() OVER (PARTITION BY name ORDER BY n DESC, county) AS i FROM t)
SELECT CAST(a.name AS BIGINT) AS id, a.county AS county_std, b.county AS corrected_county_std FROM k a JOIN k b ON a.name = b.name AND b.i = 1 AND a.n < a.top WHERE NOT list_has_any(a.years, b.years)""")
def county_slips(spark, sf_dir):
    k, y = F.col("o_custkey"), F.year("o_orderdate")
    county = F.when((k % 3 == 0) & (y >= 1997), "x").when((k % 3 == 1) & (F.col("o_orderpriority") == "1-URGENT"), "x").otherwise("y")
    rows = table(spark, sf_dir, "orders").select(k.cast("long").alias("id"), k.cast("string").alias("school_name_std"), county.alias("county_std"), y.cast("string").alias("year"))
    schools = rows.groupBy("id", "school_name_std", "county_std").agg(F.count("*").alias("n_records"), F.collect_set("year").alias("years"))
    return rosters.county_slips(schools, "id")


@query("cost_estimate", """WITH c AS (SELECT 'geocoding' AS api, count(DISTINCT user_id) * 500 AS n, 4000 AS prior, 5.0 AS usd, 10000 AS free, 0.86 AS f FROM events UNION ALL SELECT 'place_details_pro', count(DISTINCT event_type) * 1500, 0, 17.0, 5000, 0.46 FROM events),
e AS (SELECT *, round_even(CAST(n * f AS DOUBLE), 0) AS x FROM c)
SELECT api, CAST(n AS BIGINT) AS requests_ceiling, CAST(x AS BIGINT) AS requests_expected, CAST(prior AS BIGINT) AS requests_before, CAST(round(x * usd / 1000, 2) AS DOUBLE) AS usd_list_expected, CAST(round(n * usd / 1000, 2) AS DOUBLE) AS usd_list_ceiling,
CAST(round((greatest(prior + x - free, 0) - greatest(prior - free, 0)) * usd / 1000, 2) AS DOUBLE) AS usd_after_free_expected, CAST(round((greatest(prior + n - free, 0) - greatest(prior - free, 0)) * usd / 1000, 2) AS DOUBLE) AS usd_after_free_ceiling FROM e""")
def cost_estimate(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    asked = lambda api, key, times: costs.would_ask(events, [key]).select(F.lit(api).alias("api"), (F.col("requests") * times).alias("requests"))
    prior = spark.createDataFrame([("geocoding", 4000)], "api string, prior long")
    return costs.estimate(asked("geocoding", "user_id", 500).union(asked("place_details_pro", "event_type", 1500)), prior)


def rosters_of(spark, sf_dir):
    """Records, a directory and a department's list, made of parts: three spellings of the same schools."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size").repartition(4 * spark.sparkContext.defaultParallelism)  # few bytes a row, but much to clean
    school = F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string"), F.lit(" Elementary School"))
    shared = [F.col("p_brand").alias("county"), F.concat(F.col("p_size").cast("string"), F.lit(" Oak Street")).alias("street"), F.lit("public").alias("school_type")]
    typo = F.concat(F.substring(school, 1, 4), F.lit("x"), F.substring(school, 5, 200))
    years = part.withColumn("year_source", F.explode(F.array(F.lit("2020"), F.lit("2021"))))
    records = years.select((F.col("p_partkey") * 10 + F.col("year_source").cast("int") % 10).alias("vacc_data_id"), F.when(F.col("p_partkey") % 4 == 0, typo).otherwise(school).alias("school_name"), "year_source", *shared)
    listed = part.where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("id"), school.alias("name"), F.lit("p,e").alias("levelCode"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), F.lit("53000").alias("zip"), *shared)
    directory = cleaners.directory(listed.withColumnsRenamed({"street": "street1", "school_type": "schoolType"}), po_box="keep").withColumnRenamed("id", "data1_id")
    department = cleaners.department(part.where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("data2_id"), school.alias("school_name"), F.lit("K-5").alias("grades"), *shared))
    return cleaners.kindergarten(records), directory, department


@query("standardize_schools")
def standardize_schools(spark, sf_dir):
    durable(spark)
    return standardize.standardize(*rosters_of(spark, sf_dir)).joined.select("vacc_data_id", "year_source", "school_name_std", "county_std", "school_id", "match_method", "level_code_master")
