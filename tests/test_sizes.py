"""What must not grow faster than the tables: work that a row repeats, pairs that a task holds, rows that the driver gets."""

import pytest
from pyspark.sql import functions as F

from musterline.functions import address, grades, text


def planned(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_an_address_is_rewritten_once(spark):
    df = spark.createDataFrame([("12 North Oak Street, Suite 4",), (" ",), (None,)], "a string").select(address.clean_address(F.col("a")).alias("b"))
    assert [r["b"] for r in df.collect()] == ["12 N OAK STREET STE 4", None, None]
    assert planned(df).count("regexp_replace(") <= 20  # each rule once


def test_names_and_grades_are_rewritten_once(spark):
    from musterline.sources import cleaners

    rows = spark.createDataFrame([("Oak E.S. & Middle", "Howard County", "PK-5", "1 Elm St")], "school_name string, county string, grades string, street string")
    df = cleaners.department(rows).select("school_name_std", "school_level", "level_code")
    assert df.first() == ("oak", "Elementary/Middle", "p,e")
    assert planned(df).count("regexp_replace(") <= 60


def test_a_hot_cell_is_cut_and_nothing_is_broadcast(spark, monkeypatch):
    from musterline.operators import places

    monkeypatch.setattr(places, "PAIRS", 50, raising=False)
    rows = [(i, 40 + i % 7 / 20000, -80 + i % 5 / 20000) for i in range(70)]
    side = lambda p: spark.createDataFrame(rows, "id long, lat double, lon double").toDF(f"{p}_id", f"{p}_lat", f"{p}_lon")
    near, every = places.within(side("l"), side("r"), 120), places.within(side("l"), side("r"), 120_000)
    assert every.count() == 70 * 70 and near.select("l_id", "r_id").distinct().count() == near.count() == 70 * 70
    assert "__part" in planned(near)
    plan = near._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin [__cell" not in plan


def test_one_name_is_not_joined_in_pairs(spark):
    from musterline.operators import linkage

    rows = lambda i: spark.range(300).select(F.col("id").alias(i), F.lit("oak").alias("n"), F.when(F.col("id") % 3 > 0, F.col("id") % 2).cast("string").alias("c"), (F.col("id") % 5).cast("string").alias("z"))
    for require in ("any", "all"):
        df = linkage.exact(rows("a"), rows("b"), "n", ["c", "z"], "a", "b", require).matched
        assert "Window" not in planned(df) and planned(df).count("Aggregate") >= 3
        got = df.collect()
        assert len({r["orig_id_1"] for r in got}) == len({r["orig_id_2"] for r in got}) == len(got)
        assert (1, 1) in {tuple(r) for r in got}


def test_waves_grow_with_the_logarithm_of_the_keys(spark, tmp_path, monkeypatch):
    import pandas as pd

    from musterline.operators import service

    def told(frames):
        for f in frames:
            yield pd.DataFrame({"k": f["k"], "rows": len(f)})

    service.durable(spark)
    monkeypatch.setattr(service, "WAVES", 4, raising=False)
    s = service.Service("x", told, "k string, rows long", str(tmp_path), slots=1, chunk=2)
    s.ask(spark.range(80).select(F.col("id").cast("string").alias("k")), "test")
    every = s.every(spark)
    n, keys, waves, most = every.agg(F.count("*"), F.countDistinct("k"), F.countDistinct("asked_in"), F.max("rows")).first()
    assert n == keys == 80 and waves <= 20 and most <= 2


def test_a_name_and_county_are_compared_once(spark, monkeypatch):
    import pandas as pd

    from musterline.functions import similarity
    from musterline.operators import review

    seen, own = spark.sparkContext.accumulator(0), similarity.sounds.func

    @F.pandas_udf(similarity.SOUNDS)
    def counted(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        seen.add(len(a))
        return own(a, b)

    monkeypatch.setattr(similarity, "sounds", counted)
    schools = spark.range(60).select(F.concat(F.lit("s"), "id").alias("school_name"), F.lit("c").alias("county_std"), F.lit("oak hill").alias("school_name_std"), F.lit(40.0).alias("lat"), F.lit(-80.0).alias("lon"))
    listed = spark.range(60).select(F.concat(F.lit("r"), F.lpad("id", 2, "0")).alias("school_name"), F.lit("oak hills").alias("school_name_std"), F.lit("c").alias("county_std"))
    got = review.candidates(schools, review.reference(listed), "x").select("school_name", "x_name", "x_sim").collect()
    assert len(got) == 60 and {tuple(r)[1:] for r in got} == {("r00", 0.978)} and 1 <= seen.value <= 10


def test_no_task_holds_a_place_with_all_its_schools(spark):
    from musterline.operators import review

    places = spark.range(3).select(F.col("id").alias("place_id"), F.lit(40.0).alias("lat"), F.lit(-80.0).alias("lon"), F.lit("oak").alias("name"))
    listed = spark.range(5).select(F.concat(F.lit("n"), "id").alias("nces_id"), F.lit("d").alias("nces_source"), F.lit("oak").alias("nces_name"), F.lit("OPERATIONAL").alias("business_status"), F.lit(40.0).alias("lat"), F.lit(-80.0).alias("lon"), F.array(F.lit("oak")).alias("names"))
    found = review.match_directory(places, listed)
    assert "Window" not in planned(found) and [(r["place_id"], r["nces_id"], r["name_sim"]) for r in found.orderBy("place_id").collect()] == [(i, "n0", 1.0) for i in range(3)]


def test_no_pass_of_a_cascade_is_broadcast_or_holds_those_before(spark, monkeypatch):
    from musterline.operators import linkage

    frame, plans = type(spark.range(1)), []
    whole = frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda df, *a: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or whole(df, *a))
    linkage.durable(spark)
    rows = lambda i: spark.createDataFrame([(k, f"oak {k}" if k < 3 else f"elm hill {k}{i}", "a", None if k % 2 else "z") for k in range(6)], f"{i} long, n string, c string, z string")
    step = lambda name, block: linkage.Pass(name, lambda a, b: linkage.fuzzy(a, b, "n", block, "x", "y", 0.2, 0.2, 0.01))
    steps = [step("both", ["c", "z"]), step("z", ["z"]), step("c", ["c"]), step("again", ["c"])]
    found = linkage.cascade(rows("x"), rows("y"), steps, "x", "y").matched
    assert {(r["orig_id_1"], r["orig_id_2"]) for r in found.collect() if r["orig_id_1"] < 3} == {(k, k) for k in range(3)}
    assert found.where("pass = 'both'").count() >= 3 and not any("BroadcastHashJoin" in p for p in plans)
    assert max(p.count("Anti") for p in plans) <= 2
