"""Spelling variants, the vector join and periodic runs against brute force, and on nulls, ties, repeats, empty and long inputs."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, n long, word string, start string, v string"


def documents(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z", "v") for r in rows], DOCS)


# ---- periodic runs --------------------------------------------------------------------------

def plain_runs(words, repeats=4, least=6):
    """Every maximal stretch of each period, by comparing all pairs; the smallest period of a stretch stands."""
    n, found = len(words), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, repeats * q):
                found.setdefault((i, j + q - i), q)
            i = max(i + 1, j + 1) if j > i else i + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic(rng):
    """Words with runs inside runs, of few and of many different words."""
    words = []
    for _ in range(rng.randint(0, 6)):
        letters = "ab" if rng.random() < 0.5 else "abcdefgh"
        phrase = [rng.choice(letters) for _ in range(rng.randint(1, 7))]
        if rng.random() < 0.3:
            phrase = phrase * rng.randint(4, 6) + [rng.choice(letters)]
        words += phrase * rng.choice([1, 1, 2, 4, 5, 9]) + phrase[: rng.randint(0, len(phrase))]
    return [w.encode() for w in words]


@pytest.mark.parametrize("heavy", [None, 3])
def test_runs_of_small_texts(heavy, monkeypatch):
    from musterline.llm import runs

    if heavy:
        monkeypatch.setattr(runs, "heavy_from", lambda n: heavy)
    rng = random.Random(11)
    texts = [periodic(rng) for _ in range(1500)] + [[b"a"] * 700, [b"a", b"b"] * 300, [], [b"a"] * 5, [b"a"] * 6]
    for words, (found, kept) in zip(texts, runs.found_in(texts)):
        want = plain_runs(words)
        assert found == want, words
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert kept == [w for i, w in enumerate(words) if i not in gone]


def test_lag_counts_are_exact():
    from musterline.llm.runs import heavy_from, lag_counts

    rng = np.random.default_rng(4)
    sizes = np.array([5000, 0, 3, 900])
    ids = np.minimum(rng.geometric(0.3, sizes.sum()), 40)
    assert np.bincount(ids[:5000]).max() >= heavy_from(5000) > np.bincount(ids[:5000])[10]
    low = 0
    for n, counts in zip(sizes, lag_counts(ids, sizes)):
        own = ids[low : low + n]
        low += n
        assert len(counts) == n // 4 + 1
        assert counts[1:].tolist() == [int((own[:-q] == own[q:]).sum()) for q in range(1, len(counts))]


def test_periodic_runs_of_documents(spark):
    from musterline.llm.runs import digests, periodic_runs, repeated

    rng = random.Random(2)
    texts = [None, "", " \t\n", "a a a a a a", " ".join("ab cd ef".split() * 400), " ".join(map(str, range(9000))), "é é é é é é é x"]
    texts += [" ".join(w.decode() for w in periodic(rng)) for _ in range(60)] + [" ".join(rng.choices("abcdefghijk", k=rng.randint(1, 300))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, "b b b b b b b"), (-3, "c d c d c d c d")]
    got = Counter(map(tuple, digests(periodic_runs(documents(spark, rows), prepare=repeated)).collect()))
    want, seen = Counter(), set()
    for i, t in rows:
        words = (t or "").encode().split()
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and words:
            seen.add(i)
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = plain_runs(words)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        want[i, len(runs), s, n, q, 1000 * n // q if runs else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()] += 1
    assert got == want and len(seen) > 5
    assert periodic_runs(documents(spark, [])).count() == 0


# ---- spelling variants ----------------------------------------------------------------------

def apart(a, b):
    """Whether one inserted, deleted or replaced code point makes a of b."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows, noise):
    import re

    n = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{i}:{w}".encode()) if i is not None else 1
            if noise and h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    near = {w: [x for x in n if apart(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def test_spelling_variants(spark, monkeypatch):
    from musterline.llm import variants

    rng = random.Random(8)
    rows = [(0, None), (1, ""), (2, "123 !!"), (None, "ÀàÉéÜü " * 7 + "colour color " * 40)]
    stems = ["".join(rng.choices("abcé", k=rng.randint(5, 9))) for _ in range(60)] + ["aaaaaa", "aaaaaaa", "ababab", "bababa", "abababa", "q" * 3000, "q" * 3001]
    for i in range(3, 240):
        out = []
        for _ in range(rng.randint(1, 60)):
            w = rng.choice(stems[: 1 + int(len(stems) * rng.random() ** 3)])
            if rng.random() < 0.2:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", "X", w[k] + "é"]) + w[k + 1 :]
            out.append(w)
        rows.append((i, ", ".join(out)))
    rows += [(300 + i, s + " ") for i, s in enumerate(["colour " * 250, "couleur " * 6, "colourr " * 45, "colourre " * 9])] + [rows[20]] * 3
    for noise in (False, True):
        want = plain_variants(rows, noise)
        got = {tuple(r) for r in variants.spelling_variants(documents(spark, rows), noise=noise).collect()}
        assert got == want and len(want) > 60
    assert any(r[2] != r[1] and r[1] for r in want)  # a chain of forms
    monkeypatch.setattr(variants, "CHUNK", 4)  # every common bigram is many tasks' work
    monkeypatch.setattr(variants, "BUCKET_ROWS", 50)
    assert {tuple(r) for r in variants.spelling_variants(documents(spark, rows), noise=True).collect()} == want
    assert variants.spelling_variants(documents(spark, [])).count() == 0


def test_three_rarest_bigrams_find_every_neighbour(spark):
    from musterline.llm.variants import near_pairs

    rng = random.Random(1)
    words = {"".join(rng.choices("ab", k=rng.randint(6, 9))) for _ in range(500)} | {"".join(rng.choices("abcdeß"[:5], k=6)) for _ in range(500)}
    words = sorted(words)
    got = [(r["a"], r["b"]) for r in near_pairs(spark.createDataFrame([(w, 5) for w in words], "word string, n long")).collect()]
    assert len(got) == len({frozenset(p) for p in got})
    assert {frozenset(p) for p in got} == {frozenset((a, b)) for i, a in enumerate(words) for b in words[:i] if apart(a, b)}


# ---- vectors --------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label string, block long, node string, dim string"


def plain_links(rows, cosine):
    """(vec_id, n_links, component_id, kept) of each row by comparing all pairs."""
    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    vs = [np.array(v, np.float32).astype(float) if good(v) else None for _, v in rows]
    n, parent = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(vs):
        for j, b in enumerate(vs[:i]):
            if a is not None and b is not None and len(a) == len(b):
                a1, b1 = a / np.abs(a).max(), b / np.abs(b).max()
                if a1 @ b1 / (np.linalg.norm(a1) * np.linalg.norm(b1)) >= cosine:
                    n[i] += 1
                    n[j] += 1
                    parent[max(find(i), find(j))] = min(find(i), find(j))
    members = {}
    for i, (vec, _) in enumerate(rows):
        members.setdefault(find(i), []).append(vec)
    low = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    return Counter((vec, n[i], low[find(i)], vec == low[find(i)]) for i, (vec, _) in enumerate(rows))


def some_vectors():
    rng = np.random.default_rng(6)
    rows = [(0, None), (1, []), (2, [0.0] * 12), (3, [1.0, None] + [0.0] * 10), (4, [float("nan")] * 12), (5, [float("inf")] + [0.0] * 11), (None, None)]
    centres = rng.normal(size=(12, 12))
    for c in centres:
        rows += [(len(rows), (c + rng.normal(size=12) * s).tolist()) for s in rng.choice([0.02, 0.2, 0.4], 20)]
    rows += [(len(rows) + i, (centres[0] * 3.0 + rng.normal(size=12) * 0.001).tolist()) for i in range(60)]  # all of them linked
    rows += [(len(rows) + i, centres[1].tolist()) for i in range(30)] + [rows[40]] * 3 + [(None, centres[1].tolist()), (7, centres[2].tolist()), (7, centres[3].tolist())]
    rows += [(5000 + i, [math.cos(i / 6), math.sin(i / 6)]) for i in range(60)]  # a chain, of another length
    rows += [(6000, [1e-38] * 12), (6001, [3e38] * 12), (6002, [1.0])]
    return rows


@pytest.mark.parametrize("block,leaf", [(4096, 128), (16, 4)])
def test_near_vectors(spark, monkeypatch, block, leaf):
    from musterline.llm import gridjoin

    monkeypatch.setattr(gridjoin, "BLOCK_ROWS", block)
    monkeypatch.setattr(gridjoin, "LEAF", leaf)
    rows = some_vectors()
    frame = spark.createDataFrame([(*r, "l", 1, "n", "d") for r in rows], VECTORS)
    got = Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in gridjoin.near_vectors(frame).collect())
    want = plain_links(rows, 0.95)
    want = Counter({(v, n, c, k if c is not None else True): m for (v, n, c, k), m in want.items()})
    assert got == want and max(x[1] for x in want) > 60
    assert gridjoin.near_vectors(frame.limit(0)).count() == 0


def test_labels_of_edges():
    from musterline.llm.gridjoin import labels_of

    rng = np.random.default_rng(3)
    i, j = rng.integers(0, 400, 300), rng.integers(0, 400, 300)
    i, j = np.append(i, np.arange(400, 499)), np.append(j, np.arange(401, 500))
    label = labels_of(500, i, j)
    assert (label[i] == label[j]).all() and (label <= np.arange(500)).all() and (label[label] == label).all()
    assert len(set(label)) == 500 - np.linalg.matrix_rank(np.eye(500)[i] - np.eye(500)[j])


# ---- hashes of words ------------------------------------------------------------------------

def test_word_hashes_tell_patterned_words_apart():
    from musterline.llm.shared import word_hashes

    morse = b"".join(b"ab"[bin(i).count("1") % 2 :][:1] for i in range(2048))
    mirror = morse.translate(bytes.maketrans(b"ab", b"ba"))
    rng = random.Random(2)
    words = [morse[:n] for n in range(1, 2048, 7)] + [mirror[:n] for n in range(1, 2048, 7)] + [b"a" * n for n in range(1, 40)] + [b"\0" * n for n in range(1, 40)]
    words += [bytes(rng.choices(range(33, 256), k=rng.randint(1, 30))) for _ in range(3000)]
    words = sorted(set(words))
    rng.shuffle(words)
    raw = np.frombuffer(b" ".join(words + words[::-1]), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words + words[::-1]]) - 1
    starts = ends - np.array([len(w) for w in words + words[::-1]])
    found = word_hashes(raw, starts, ends)
    assert (found[: len(words)] == found[len(words) :][::-1]).all()  # wherever a word stands
    assert len(set(found.tolist())) == len(words)
    assert len(word_hashes(raw, starts[:0], ends[:0])) == 0


def test_patterned_words_in_three_operators(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    from musterline.llm.hpylm import score_documents
    from musterline.llm.rankbpe import encode
    from musterline.llm.rlz import substring_dedup

    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    mirror = morse.translate(str.maketrans("ab", "ba"))
    frame = documents(spark, [(0, morse), (1, mirror), (2, f"{morse[:1024]} {mirror[:1024]}")])
    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    got = {r["doc_id"]: r["ids_sha256"] for r in encode(frame, path("word_bpe_49k.json"), ids=False, digests=True).collect()}
    for i, text in enumerate([morse, mirror, f"{morse[:1024]} {mirror[:1024]}"]):
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[i] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1][0]
    kept = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 != 1][:6]
    rows = [(held, mirror[:1024] + " " + morse[:1024])] + [(i, morse[:1024] + " x y z") for i in kept]
    scored = {r["doc_id"]: r["n_known"] for r in score_documents(documents(spark, rows)).collect()}
    assert scored[held] == 2  # the word seen in training, and the end
    plain = [f"w{i}" for i in range(19)]
    twins = documents(spark, [(0, " ".join([morse[:1024], *plain])), (1, " ".join([mirror[:1024], *plain]))])
    assert {r["doc_id"]: r["n_removed"] for r in substring_dedup(twins, joined=True).collect()} == {0: 0, 1: 0}
