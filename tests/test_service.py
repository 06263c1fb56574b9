"""Questions to a paid service: each once, resumable, paced and counted."""

import sys
import time
from collections import Counter
from pathlib import Path

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from musterline.operators import geocode, runlog, service

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import the tests


def counting(path: Path, answer, fail_after: int | None = None):
    """A provider that notes every question with its time; it breaks after so many of them in all."""
    path.touch()

    def provider(frames):
        for frame in frames:
            key = frame.columns[0]
            with path.open("a") as f:
                for x in frame[key]:
                    if fail_after is not None and len(path.read_text().splitlines()) >= fail_after:
                        raise RuntimeError("service gone")
                    f.write(f"{time.time()}\t{x}\n")
                    f.flush()
            yield pd.concat([answer(x) for x in frame[key]], ignore_index=True)

    return provider


def questions(path: Path) -> Counter:
    return Counter(line.split("\t")[1] for line in path.read_text().splitlines())


def place(query: str) -> pd.DataFrame:
    none = "nowhere" in query
    return pd.DataFrame({"query": [query], "found_lat": [None if none else 1.0], "found_lon": [None if none else 2.0], "found_place_id": [None if none else "P" + query], "found_address": [None]}).astype({"found_lat": float, "found_lon": float})


def schools(spark, n=60):
    rows = [(i, f"school {i % 30}" + (" nowhere" if i % 30 == 7 else ""), f"{i % 30} Oak St" if i % 3 else None, "x", "MD", None, f"c{i % 3}") for i in range(n)]
    return spark.createDataFrame(rows, "id int, school_name string, addr_clean string, city string, state string, zip string, county_std string")


def read_twice(*frames):
    for df in frames:
        df.count()
        df.collect()


def test_plain_providers_are_asked_once(spark, tmp_path):
    log = tmp_path / "geocoded"
    read_twice(*geocode.geocoded(schools(spark), counting(log, place)))
    assert questions(log) and set(questions(log).values()) == {1}
    log = tmp_path / "names"
    rows = schools(spark).withColumns({"orig_name": F.col("school_name"), "school_name_std": F.concat(F.lit("std "), "school_name")})
    found = geocode.original_then_standard(rows.drop("school_name"), counting(log, place))
    read_twice(found)
    assert set(questions(log).values()) == {1} and found.count() == 60
    assert any(q.startswith("std ") for q in questions(log))


def state(code):
    return lambda p: pd.DataFrame({"place_id": [p], "business_status": [None], "google_place_name": [None], "status_reason": ["transient_error"], "http_status": pd.array([code], "Int32")})


def test_states_are_asked_once(spark, tmp_path):
    ids = spark.createDataFrame([(f"P{i % 20}",) for i in range(60)] + [(None,)], "place_id string")
    log = tmp_path / "states"
    read_twice(*geocode.with_status(ids, spark.createDataFrame([], "place_id string, business_status string"), counting(log, state(500))))
    assert questions(log) == {f"P{i}": 1 for i in range(20)}

    log = tmp_path / "again"
    rows = ids.withColumns({"business_status": F.lit(None).cast("string"), "google_place_name": F.lit(None).cast("string"), "status_reason": F.lit("transient_error")})

    def mended(p):
        good = questions(log)[p] > int(p[1:]) % 3  # answers after one, two or three questions
        return state(503)(p) if not good else pd.DataFrame({"place_id": [p], "business_status": ["OPEN"], "google_place_name": ["n"], "status_reason": ["success"], "http_status": pd.array([200], "Int32")})

    found = geocode.retried(rows, counting(log, mended), 5)
    read_twice(found)
    assert questions(log) == {f"P{i}": 1 + i % 3 for i in range(20)}  # and stops when all are known
    assert {(r["place_id"], r["business_status"], r["status_reason"]) for r in found.collect()} == {(f"P{i}", "OPEN", "success") for i in range(20)} | {(None, None, "missing_place_id")}
    log.unlink()
    two = geocode.retried(rows, counting(log, mended), 2)
    got = {r["place_id"]: r["status_reason"] for r in two.collect()}
    assert all(got[f"P{i}"] == ("transient_error" if i % 3 == 2 else "success") for i in range(20))


def test_a_run_that_was_cut_off_asks_only_the_rest(spark, tmp_path):
    log, folder = tmp_path / "asked", str(tmp_path / "geo")
    rows = schools(spark)
    with pytest.raises(Exception, match="service gone"):
        geocode.run(rows, counting(log, place, fail_after=11), folder, rate=None, slots=1, chunk=4)
    written = geocode.geocoder(None, folder).every(spark)
    kept = written.where("found_place_id is not null").count()
    assert written.count() == 8  # two waves were written, the third was under way
    before = questions(log)
    tally = runlog.RunLog()
    found = geocode.run(rows, counting(log, place), folder, rate=None, log=tally, slots=1, chunk=4)
    read_twice(found)
    assert {r["place_id"] is None for r in found.collect() if r["school_name"].endswith("nowhere")} == {True}
    asked = questions(log)
    assert sum(asked.values()) - sum(before.values()) == len(asked) - kept  # what the log has found is not asked again
    assert max(asked.values()) <= 1 + 4 and sum(n - 1 for n in asked.values() if n > 1) <= 4 * 4  # the wave that broke, once a try
    counted = {caller: (n, good) for (_, caller), (n, good, _) in tally.calls.items()}
    assert sum(n for n, _ in counted.values()) == len(asked) - kept and set(counted) == {"by_address", "by_name"}
    again = runlog.RunLog()
    geocode.run(rows, counting(log, place), folder, rate=None, log=again)
    lost = [q for q in asked if "nowhere" in q]
    assert sum(n for n, _, _ in again.calls.values()) == len(lost) and sum(c.get("no answer", 0) for _, _, c in again.calls.values()) == len(lost)


def test_the_rate_is_shared_by_all_tasks(spark, tmp_path):
    log = tmp_path / "asked"
    keys = spark.range(60).select(F.concat(F.lit("k"), "id").alias("query"))
    paced = geocode.geocoder(counting(log, place), str(tmp_path / "geo"), rate=20.0, slots=2, chunk=15)
    assert paced.ask(keys, "test").count() == 60
    times = sorted(float(line.split("\t")[0]) for line in log.read_text().splitlines())
    assert len(times) == 60 and times[-1] - times[0] >= 60 / 20 - 1.1  # two tasks' worth of a second may go at once
    for low in range(60):
        assert sum(times[low] <= t < times[low] + 1 for t in times) <= 2 * 20 + 1
    with pytest.raises(ValueError, match="rate must be"):
        geocode.geocoder(place, "x", rate=0)


def test_paced_frames():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    def provider(frames):
        for f in frames:
            now[0] += 0.01 * len(f)
            yield f

    out = list(service.paced(provider, 10.0, lambda: now[0], sleep)(iter([pd.DataFrame({"q": range(25)})])))
    assert [len(f) for f in out] == [10, 10, 5] and abs(now[0] - 2.5) < 1e-9 and len(slept) == 3
    assert service.paced(provider, None) is provider


def test_rehearsal_knows_what_is_known(spark, tmp_path):
    log = tmp_path / "asked"
    real = geocode.geocoder(counting(log, place), str(tmp_path / "geo"), rate=None)
    keys = spark.range(20).select(F.concat(F.lit("k"), "id").alias("query"))
    real.ask(keys.where("id < 8"), "first")
    for use_cache, n in ((True, 12), (False, 20)):
        tally = runlog.RunLog()
        dry = real.rehearsal(spark, str(tmp_path / f"dry{n}"), geocode.dry_run, tally, use_cache)
        assert dry.ask(keys, "dry").count() == 20 and tally.calls["geocoding", "dry"][0] == n
    assert sum(questions(log).values()) == 8 and real.every(spark).count() == 8
