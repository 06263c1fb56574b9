"""Names found in a list by keys, against the comparison of each name with each entry."""

import random
from collections import Counter

from musterline.functions import locations, similarity


def measures(a: bytes, b: bytes):
    x, y = Counter(a), Counter(b)
    every = set(x) | set(y)
    dot, norm = sum(x[c] * y[c] for c in every), (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
    cosine = 0.0 if not every else max(0.0, 1 - (dot / norm if norm else 0.0))
    jaccard = 1 - sum(min(x[c], y[c]) for c in every) / sum(max(x[c], y[c]) for c in every) if every else 0.0
    sound = 0 if a and b and similarity.soundex(a) == similarity.soundex(b) else 1
    osa, jw, qgram = similarity.osa(a, b), similarity.jaro_winkler(a, b), sum(abs(x[c] - y[c]) for c in every)
    return osa, jw, sound, osa + qgram + cosine + jaccard + jw + sound


def by_hand(name: str, entries: list[str]):
    scored = [(e, *measures(name.encode(), e.encode())) for e in sorted(set(entries))]
    if any(osa <= 1 or jw <= 0.1 for _, osa, jw, _, _ in scored):
        least = min(s[4] for s in scored)
        return next(s[0] for s in scored if s[4] <= least + 1e-9)
    alike = [e for e, osa, jw, sound, _ in scored if osa <= 3 and jw <= 0.31 and sound == 0]
    return ", ".join(alike) or None


def changed(word: str, edits: int, draw: random.Random) -> str:
    for _ in range(edits):
        i, kind = draw.randrange(len(word) + 1), draw.randrange(4)
        word = [word[:i] + draw.choice("abeinort") + word[i:], word[:i] + word[i + 1 :], word[:i] + draw.choice("xyz") + word[i + 1 :], word[:i] + word[i + 1 : i + 2] + word[i : i + 1] + word[i + 2 :]][kind]
    return word


def test_locations_against_all_pairs(spark):
    draw = random.Random(7)
    words = ["".join(draw.choice("abeinort") for _ in range(draw.randrange(1, 22))) for _ in range(120)]
    entries = words[40:] + [changed(w, 2, draw) for w in words[:40] for _ in range(6)] + [changed(w, draw.randrange(1, 4), draw) for w in words] + ["".join(draw.sample(w, len(w))) for w in words[:60]]
    entries += ["", "x", "é", "éa", "a" * 40, "ab" * 70, words[0] + words[1] * 2]
    asked = sorted({*(changed(w, draw.randrange(0, 5), draw) for w in words * 2), "", "y", "aé", "a" * 41, "ab" * 69 + "ba", words[0] + words[1], "qqqqqq", *words[:40]})
    one = spark.createDataFrame([(w, 1) for w in [*asked, asked[3], None]], "name string, entry int")
    many = spark.createDataFrame([(w, 2) for w in [*entries, entries[0], None]], "name string, a int")
    got = {r["name"]: r["matched"] for r in locations.match_locations(one, many, standardized=True).collect()}
    expected = {w: by_hand(w, entries) for w in asked}
    assert got == expected
    assert sum(v is None for v in got.values()) > 5 and sum(", " in (v or "") for v in got.values()) > 2 and sum(v is not None for v in got.values()) > 100


def test_locations_of_nothing(spark):
    none, some = spark.createDataFrame([], "name string"), spark.createDataFrame([("Oak",), (None,)], "name string")
    assert locations.match_locations(none, some).count() == 0
    assert [tuple(r) for r in locations.match_locations(some, none).collect()] == [("Oak", None, None)]
