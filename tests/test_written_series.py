"""The final step over all series at once, and what a reader of its folder sees."""

import pytest
from pyspark.sql import functions as F

from musterline.plans import catalogue, finalize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    catalogue.durable(spark)
    kind = F.when(F.col("school_id") % 3 == 0, "MMR").when(F.col("school_id") % 3 == 1, " polio ")
    odd = catalogue.school_years(spark, SF).withColumns({"school_id": F.col("school_id") % 40, "kind": kind})  # schools of every series
    return odd.withColumn("enrollment", F.when(F.col("year") % 5 == 0, F.col("enrollment") * 9).otherwise(F.col("enrollment"))).checkpoint()


def test_all_series_at_once_equal_each_alone(rows):
    every = finalize.finalize_all(rows, "kind")
    alone = finalize.finalize_series(rows, "kind")
    assert set(alone) == {"mmr", "polio"}
    for name, df in every.items():
        for s, one in alone.items():
            want = getattr(one, name)
            columns = [c for c in want.columns if c != "kind"]
            rounded = [F.round(F.col(c), 6).alias(c) if t == "double" else F.col(c) for c, t in want.select(*columns).dtypes]
            pick = lambda d: sorted(map(str, d.select(*rounded).collect()))  # noqa: E731, B023
            assert pick(df.where(F.col("series") == s)) == pick(want), (name, s)
    assert every["deviations"].count() and every["excluded"].count()


def test_a_reader_sees_whole_runs_only(spark, rows, tmp_path, monkeypatch):
    folder = str(tmp_path / "final")
    first = finalize.write_final(rows, "kind", folder)
    counts = {(r["table"], r["series"]): r["n_rows"] for r in first.collect()}
    assert counts["cleaned", "mmr"] + counts["excluded", "mmr"] == rows.where("kind = 'MMR'").count()
    assert finalize.read_final(spark, folder, "cleaned", "Polio").count() == counts["cleaned", "polio"]
    with pytest.raises(ValueError, match="no cleaned"):
        finalize.read_final(spark, folder, "cleaned", "hib")
    with monkeypatch.context() as m:  # a run that breaks off before its manifest
        m.setattr(finalize, "reduce", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            finalize.write_final(rows.limit(5), "kind", folder)
    assert finalize.read_final(spark, folder, "cleaned", "polio").count() == counts["cleaned", "polio"]
    with pytest.warns(UserWarning, match="hib"):
        finalize.write_final(rows.where("school_id < 9"), "kind", folder, ["polio", "Hib"])
    assert finalize.read_final(spark, folder, "cleaned", "polio").agg(F.max("school_id")).first()[0] < 9
    assert finalize.read_final(spark, folder, "cleaned", "mmr").count() == counts["cleaned", "mmr"]
