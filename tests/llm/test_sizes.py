"""What must not grow in the driver, or on disk."""

import random
from collections import Counter

from musterline.llm import simhash


def test_keys_of_fingerprints_are_not_broadcast(spark, monkeypatch):
    plans, whole = [], simhash.components
    monkeypatch.setattr(simhash, "components", lambda edges: plans.append(edges._jdf.queryExecution().sparkPlan().toString()) or whole(edges))
    docs = spark.createDataFrame([(i, f"one two three four five six {i % 3}") for i in range(9)], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 9
    assert plans and not any("BroadcastHashJoin" in p for p in plans)


def test_each_pair_of_near_fingerprints_meets_once(spark):
    rng, parts = random.Random(3), [(0, 10, 1), (10, 8, 2)]
    values = rng.sample(range(1 << 18), 300)
    nodes = spark.createDataFrame([(x, x) for x in values], "node long, w0 long")
    left, right = (simhash.keys(nodes, ["w0"], balls, parts).collect() for balls in (True, False))
    assert len(left) < 0.65 * len(values) * (11 + 37)  # of all masks, which the disk would hold with each whole fingerprint
    at = {}
    for r in right:
        at.setdefault(r["k"], []).append(r["node"])
    met = Counter((r["k"] >> 32, *sorted((r["node"], x))) for r in left for x in at.get(r["k"], []) if x != r["node"])
    for i, (low, width, radius) in enumerate(parts):
        bits = {(x, y): ((x ^ y) >> low & (1 << width) - 1).bit_count() for x in values for y in values if x < y}
        assert {k: met[i, *k] for k in bits if met[i, *k]} == {k: 1 if d else 2 for k, d in bits.items() if d <= radius}


def test_buckets_of_long_fingerprints_are_joined_in_turns(spark, monkeypatch):
    turns, whole = [], simhash.keys
    monkeypatch.setattr(simhash, "keys", lambda nodes, words, balls, parts, *turn: (balls and turns.append([*(turn or (range(len(parts)),))[0]])) or whole(nodes, words, balls, parts, *turn))
    rng = random.Random(5)
    base = [f"w{rng.randrange(999)}" for _ in range(60)]
    rows = [(i, " ".join(base[: 60 - i] if i < 3 else [f"v{rng.randrange(999)}" for _ in range(60)])) for i in range(8)]
    found = simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: 0 if i < 3 else i for i in range(8)}
    assert len(turns) > 1 and max(map(len, turns)) <= 4 and sorted(sum(turns, [])) == list(range(len(sum(turns, []))))


def test_the_join_of_buckets_is_short_enough_to_be_compiled(spark, monkeypatch):
    """The JVM interprets methods of over 8,000 bytes, however often they run."""
    import re

    codes, whole, held = [], simhash.saved, {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    monkeypatch.setattr(simhash, "saved", lambda df, *a: codes.append(df._jdf.queryExecution().explainString(mode)) or whole(df, *a))
    rng = random.Random(6)
    docs = spark.createDataFrame([(i, " ".join(f"v{rng.randrange(99)}" for _ in range(30))) for i in range(6)], "doc_id long, text string")
    try:
        for k, v in zip(held, ("false", "-1")):
            spark.conf.set(k, v)
        assert simhash.similar_documents(docs).count() == 6
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    found = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", " ".join(codes))]
    assert len(found) > 20 and max(found) < 8000
