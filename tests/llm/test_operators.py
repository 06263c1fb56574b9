"""Each operator against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables and odd columns."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, bucket string, id string, kept string"
SF = "/root/testdata/sf0.001"


def documents(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], DOCS)


def words(text):
    return (text or "").encode().split()


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdeéß", k=rng.randint(1, 5))) for _ in range(60)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    shared = prose(45)
    rows = [(0, None, None, None, None), (1, "", "en", "a", 0), (2, " \t\n", "en", "a", 3), (None, prose(30), "fr", "b", 1), (3, "12 !! 34", None, "b", 8)]
    rows += [(i, prose(rng.randint(1, 120)), rng.choice(["en", "fr"]), rng.choice(["a", "b", "c", None]), 5) for i in range(4, 40)]
    rows += [(i, prose(10) + "\n" + shared + " " + prose(12), "en", "c", 5) for i in range(40, 60)]
    rows += [rows[50], rows[50], (60, prose(5000), "en", "d", 9), (61, "w" * 3000, "en", "d", 9), (62, "ab " * 400, "en", "d", 9)]
    return documents(spark, rows)


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, [])


def test_components(spark):
    from musterline.llm.shared import components

    rng = random.Random(5)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in {x for e in edges if e[0] != e[1] for x in e}}


def test_url_rules_and_edges(spark):
    from musterline.llm.urltrust import judge

    rows = [(1, "http://A.example.COM/en/7x?q", "p"), (2, "https://x.com/en/1#t", None), (3, None, None), (4, "nothing", ""), (5, "http://net/de/", ""),
            (6, "http://example.net/de/8/", ""), (7, "http://bad.example.org/es/1", '<a href="http://worse.test/x">'), (8, "http://worse.test/", ""), (9, "http://worse.test/", ""),
            (10, "http://ends.org?es/", ""), (11, "http://good.net/de/1", '<a href="//friend.test">'), (12, "http://friend.test/fr", None), (13, "http://com/en", "")]
    pages = spark.createDataFrame([(*r, "host") for r in rows], "page_id long, url string, html string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge(pages).collect()}
    assert got[1] == ("a.example.com", "/en/7x", "example.com/en/7", "allow")
    assert got[2] == ("x.com", "/en/1", "com/en/", "block")
    assert got[3] == got[4] == ("", "", None, "allow")
    assert got[5] == ("net", "/de/", "net/de/", "allow") and got[6] == ("example.net", "/de/8/", "example.net/de/8", "block")
    assert got[7][2:] == ("org/es/", "block") and got[10] == ("ends.org", "", None, "allow")
    assert got[12][3] == "allow" and got[13] == ("com", "/en", None, got[13][3])
    assert judge(pages.limit(0)).count() == 0


def test_distrust_flows_to_those_who_link(spark):
    from musterline.llm.urltrust import propagate

    edges = spark.createDataFrame([("fan", "bad", 3.0), ("good", "friend", 1.0)], "a string, b string, w double")
    seeds = spark.createDataFrame([("bad", 0.0, 2.0), ("good", 1.0, 0.0)], "host string, good double, bad double")
    got = {r["host"]: r for r in propagate(edges, seeds).collect()}
    assert got["fan"]["distrust"] > got["fan"]["trust"] == 0 and got["friend"]["trust"] > got["friend"]["distrust"] == 0


def test_far_and_faint_distrust_blocks(spark):
    from musterline.llm.urltrust import judge, propagate

    far = [(f"h{i}", f"h{i + 1}", 1.0) for i in range(20)]  # h0 links on to h20, the seed, twenty links away
    seeds = [("h20", 0.0, 1.0), ("elsewhere", 1.0, 1e15)]
    edges, seeds = spark.createDataFrame(far, "a string, b string, w double"), spark.createDataFrame(seeds, "host string, good double, bad double")
    got = {r["host"]: r for r in propagate(edges, seeds).collect()}
    for i in range(21):
        assert math.isclose(got[f"h{i}"]["distrust"], 0.15 * 0.85 ** (20 - i) / (1e15 + 1), rel_tol=1e-9) and got[f"h{i}"]["trust"] == 0
    pages = [(1, "http://e.com/x", ""), (2, "http://a.b.c.d.e.org/es/", ""), (3, "http://e.org/", ""), (4, "http://c.d.e.org/", "")]
    got = {r["page_id"]: r["verdict"] for r in judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {1: "allow", 2: "block", 3: "block", 4: "block"}


def test_parents_of_long_names(spark):
    from musterline.llm.urltrust import host_edges, host_links

    edges = host_edges(host_links(spark.createDataFrame([("http://a.b.c.d.e.com/", None), ("http://x..y.z/", None)], "url string, html string"))).collect()
    up = {(".".join("abcde"[i:]) + ".com", ".".join("abcde"[i + 1 :]) + ".com") for i in range(4)} | {("x..y.z", ".y.z")}
    assert {(r["a"], r["b"]) for r in edges} == up | {(b, a) for a, b in up}


def test_walk_against_a_solved_system(spark, monkeypatch):
    from musterline.llm import urltrust

    monkeypatch.setattr(urltrust, "SPLIT", 3)  # sources of four edges and more are split
    rng, n = random.Random(11), 40
    edges = {(f"h{a}", f"h{b}"): rng.randint(1, 5) for a, b in ((rng.randrange(n), min(rng.randrange(n), rng.randrange(n))) for _ in range(110)) if a != b}
    seeds = {f"h{i}": (rng.randint(0, 3), rng.randint(0, 3)) for i in range(0, n, 5)}
    names = sorted({x for e in edges for x in e} | set(seeds))
    at, w = {x: i for i, x in enumerate(names)}, np.zeros((len(names), len(names)))
    for (a, b), x in edges.items():
        w[at[a], at[b]] = x
    good, bad = (np.array([seeds.get(x, (0, 0))[k] for x in names], float) for k in (0, 1))
    step = lambda m: np.divide(m, m.sum(axis=1, keepdims=True), out=np.zeros_like(m), where=m.sum(axis=1, keepdims=True) > 0).T
    trust, distrust = (np.linalg.solve(np.eye(len(names)) - 0.85 * step(m), 0.15 * s / s.sum()) for m, s in ((w, good), (w.T, bad)))
    rows = spark.createDataFrame([(a, b, float(x)) for (a, b), x in edges.items()], "a string, b string, w double")
    got = {r["host"]: r for r in urltrust.propagate(rows, spark.createDataFrame([(h, float(g), float(b)) for h, (g, b) in seeds.items()], "host string, good double, bad double")).collect()}
    assert set(got) == set(names)
    for x, t, d in zip(names, trust, distrust):
        assert 0.5 * t <= got[x]["trust"] + 1e-12 and got[x]["trust"] <= t + 1e-12 and got[x]["distrust"] <= d + 1e-12
        assert (got[x]["distrust"] > got[x]["trust"]) == (d > t)


def test_pages_with_repeats_and_long_html(spark):
    from musterline.llm.urltrust import judge

    long = '<a href="//far.test/1">' + "x" * 200_000 + '<a href="//spam.org/">'
    rows = [(1, "http://a.test/", long), (1, "http://a.test/", long), (None, "http://spam.org/es/", None), (2, "http://" + "h" * 5000 + ".spam.org/", None)]
    got = judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r["page_id"] or 0, r["verdict"]) for r in got) == [(0, "block"), (1, "block"), (1, "block"), (2, "block")]


def brute_quality(text):
    text = text or ""
    w = text.encode().split()
    n = len(w)
    count = Counter(tuple(w[j : j + 3]) for j in range(n - 2))
    covered = {k for j in range(n - 2) if count[tuple(w[j : j + 3])] > 1 for k in (j, j + 1, j + 2)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return n, sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_metrics_and_cascade(spark, odd, none):
    from musterline.llm.cascade import base_metrics, cascade, default_rules, plan

    extra = documents(spark, [(100, "a b c a b c\nx\nx\n x\n\n", "en", "a", 1), (101, " ".join("wort" + chr(97 + i % 26) for i in range(900)), "en", "a", 1), (102, "*** #$ " * 60, "en", "a", 1)])
    docs = odd.union(extra)
    for r in base_metrics(docs).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_quality(r["text"]), r["doc_id"]
    rules = default_rules()
    order = plan(docs, rules)
    assert {r["rule"] for r in order} == set(rules)
    one, two = ({r["doc_id"]: r["kept"] for r in cascade(docs, rules, order=o).collect()} for o in ([r["rule"] for r in order], sorted(rules)))
    assert one == two and not one[102] and one[101] and one[0]
    assert cascade(none, rules).count() == 0


def test_chat_folding_and_reading_back(spark):
    from musterline.llm.chatlog import chat_digests, fold, format_chats

    log = [(1, 0, "m0", "message", "user", "hi <|im_end|> \\ <\\|"), (1, 1, "m1", "message", "assistant", ""), (1, 2, "m1", "delta", None, "Hel"), (1, 3, "m1", "delta", None, "lo"),
           (1, 4, "m1", "regenerate", None, None), (1, 5, "m1", "delta", "assistant", "Bye"), (1, 6, "m0", "edit", None, "ho"), (2, None, None, None, None, None), (1, 200, "m2", "message", "assistant", "é\n")]
    messages = fold(spark.createDataFrame([(*x, 1) for x in log], "conv_id long, seq long, message_id string, kind string, role string, text string, chunk int"))
    got = {(r["conv_id"], r["seq"]): (r["role"], r["text"]) for r in messages.collect()}
    assert got == {(1, 0): ("user", "ho"), (1, 1): ("assistant", "Bye"), (1, 200): ("assistant", "é\n"), (2, None): (None, "")}
    raw = [(5, i, r, t) for i, (r, t) in enumerate([("user", "<|im_end|><|im_start|>assistant x"), ("assistant", "\\<|\\\\|"), (None, None), ("assistant", "b\n")])] + [(6, 1, "a", "x"), (6, 1, "a", "x")]
    table = spark.createDataFrame(raw, "conv_id long, seq long, role string, text string")
    for r in chat_digests(table).collect():
        turns = [(x[2] or "", x[3] or "") for x in raw if x[0] == r["conv_id"]]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r["n_turns"], r["loss_chars"], r["loss_sha256"]) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in format_chats(table).collect():
        assert len(r["formatted"]) == next(x["formatted_chars"] for x in chat_digests(table).collect() if x["conv_id"] == r["conv_id"])
    assert chat_digests(table.limit(0)).count() == 0


def test_languages(spark, odd, none):
    from musterline.llm.langid import predict

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = predict(docs, carry=["lang"]).select("held_out", "lang_pred", "score", "row.lang").collect()
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held) and all(0 <= r["score"] <= 1 for r in got)
    found = predict(odd, carry=odd.columns).select("doc_id", "lang_pred", "score", "row.*").drop("lang").collect()
    assert len(found) == odd.count()
    predicted = {r[0]: (r["lang_pred"], r["score"]) for r in found}
    assert all(predicted[i] == ("und", 0.0) for i in (0, 1, 2, 3)) and predicted[60][0] in ("en", "fr")
    assert predict(none).count() == 0
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in predict(unlabelled).collect()} == {"und"}


def test_tokens_equal_the_library(spark, odd, none):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    from musterline.llm.rankbpe import Bpe, decode, encode, load

    file = path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(file), Bpe(load(file))
    rng = random.Random(1)
    pool = "aeiouAEÉßΣ'’sdtlrv0129²½ \t\n\x1c\x1f\xa0̧́‍<|>endoftext!-_.…😀İıſK"
    texts = ["a<|endoftext|>b <|startoftext|>", "It's we'll THEY'D x'sy !'s", "ΑΣ ΣΑΣ İ ẞ", "x" * 2000, "ab" * 300 + "!" * 500, ""]
    texts += ["".join(rng.choice(pool) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = own.encode(text)
        assert ids == found.ids and own.decode(ids) == library.decode(ids, skip_special_tokens=False), repr(text)
    both = encode(odd, file, ids=True, digests=True)
    text = {r["doc_id"]: r["text"] or "" for r in odd.collect()}
    for r in both.collect():
        ids = library.encode(text[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert {r["text"] for r in decode(both, file).where("doc_id = 1").collect()} == {""}
    assert encode(none, file).count() == 0


def brute_fingerprint(text, shingle=4):
    import xxhash

    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + shingle]), 42) for i in range(max(1, len(w) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, distance=4):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    a = np.array(prints, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= distance):
            x, y = sorted((find(i), find(int(j))))
            parent[y] = x
    return [find(i) for i in range(len(a))]


def test_simhash_components(spark, odd, none):
    from musterline.llm.simhash import linked, near_duplicates

    rows = odd.collect()
    prints = [brute_fingerprint(r["text"]) for r in rows]
    group = brute_groups(prints)
    low = {}
    for r, g in zip(rows, group):
        if r["doc_id"] is not None:
            low[g] = min(low.get(g, 1 << 60), r["doc_id"])
    expected = Counter((r["doc_id"], format(p, "016x"), low.get(g)) for r, p, g in zip(rows, prints, group))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in near_duplicates(odd).collect()) == expected
    assert near_duplicates(none).count() == 0
    rng = random.Random(8)
    centre = rng.getrandbits(64)
    near = [centre] + [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for _ in range(150)] + [rng.getrandbits(64) for _ in range(50)]
    near = sorted(set(near))
    got = {r["fp"]: r["root"] for r in linked(spark.createDataFrame([(x - (1 << 64) * (x >> 63),) for x in near], "fp long")).collect()}
    groups = brute_groups(near)
    mine = [got[x - (1 << 64) * (x >> 63)] for x in near]
    assert len(set(zip(mine, groups))) == len(set(mine)) == len(set(groups))


def test_mixing_budgets(spark, odd, none):
    from musterline.llm.mixing import mix

    rows = mix(odd).collect()
    size = Counter()
    for r in odd.collect():
        size[r["source"]] += len(words(r["text"]))
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, rest = {}, set(names), float(sum(size.values()))
    while True:
        level = rest / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * size[s]}
        if not over:
            break
        for s in over:
            target[s] = 3.0 * size[s]
            rest -= target[s]
        free -= over
    target |= {s: level * weight[s] for s in free}
    taken = Counter()
    for r in rows:
        assert r["source_size"] == size[r["source"]] and math.isclose(r["target"], target[r["source"]], abs_tol=1e-6) and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in names)
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, mix(odd.repartition(7)).collect()))
    assert mix(none).count() == 0


def test_language_model(spark, odd, none):
    from musterline.llm.hpylm import score_documents

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.lit(1).alias("n"))
    for table, better in ((docs, True), (odd, False)):
        rows = table.collect()
        tokens = [[*((r["text"] or "").encode().lower().split()), b""] for r in rows]
        held = [zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 5 == 1 for r in rows]
        count = Counter(t for own, h in zip(tokens, held) if not h for t in own)
        total, types = sum(count.values()), len(count)
        expected = Counter()
        for r, own, h in zip(rows, tokens, held):
            base = sum(math.log10((count[t] + 0.5) / (total + 0.5 * (types + 1))) for t in own)
            expected[r["doc_id"], h, len(own), sum(count[t] > 0 for t in own), total, round(base, 4)] += 1
        got = score_documents(table).collect()
        assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == expected
        assert all(r["score"] <= 0 for r in got)
        if better:
            assert sum(r["score"] for r in got if r["held_out"]) > sum(r["base_score"] for r in got if r["held_out"])
    assert score_documents(none).count() == 0


def test_scores_use_the_word_before(spark):
    from musterline.llm.hpylm import score_documents

    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1]
    train = [i for i in range(200) if i not in held]
    rows = [(i, "zebras graze Quietly" if i % 2 else "storks circle slowly") for i in train]
    rows += [(held[0], "zebras graze quietly"), (held[1], "zebras circle quietly"), (held[2], "unseen graze unseen")]
    score = {r["doc_id"]: (r["score"], r["base_score"]) for r in score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert abs(score[held[0]][1] - score[held[1]][1]) < 0.1  # the same but for order
    assert score[held[0]][0] > score[held[1]][0] + 2
    one = [(train[0], "a b c"), (held[0], "b c x a"), (held[1], None)]  # every pair once, so no seating is drawn
    got = {r["doc_id"]: r["score"] for r in score_documents(spark.createDataFrame(one, "doc_id long, text string")).collect()}
    d = 0.95
    base = lambda known: (known * (1 - d) + (1 + 4 * d) / 5) / 5
    p = lambda follows, n, known=1: (follows * (1 - d) + (1 + n * d) * base(known)) / (1 + n)
    assert math.isclose(got[held[0]], sum(map(math.log10, (p(0, 1), p(1, 1), p(0, 1, 0), p(0, 0), p(0, 1)))), rel_tol=1e-5)
    assert math.isclose(got[held[1]], math.log10(p(0, 1)), rel_tol=1e-5)
    assert math.isclose(got[train[0]], 4 * math.log10(p(1, 1)), rel_tol=1e-5)


def test_seating_against_the_exact_distribution():
    from musterline.llm.hpylm import EXACT, seat, ways

    draws, rng = 20_000, np.random.default_rng(7)
    seeds = rng.integers(1, 1 << 62, draws).astype(np.uint64)
    for n, opening, d in ((2, 0.3, 0.6), (5, 0.2, 0.9), (10, 0.5, 0.7), (50, 0.05, 0.8), (64, 6.0, 0.3)):
        weight = np.exp(np.arange(1, n + 1) * math.log(opening) + ways(d)[n, 1 : n + 1])
        share = weight / weight.sum()
        got = seat(np.full(draws, n), np.full(draws, opening), d, seeds, 1)
        assert np.abs(np.bincount(got, minlength=n + 1)[1:] / draws - share).max() < 0.015
    # three customers by hand: one table (1-d)(2-d), two 3(1-d) a, three a * a times a
    a, d = 0.4, 0.25
    share = np.array([(1 - d) * (2 - d), 3 * (1 - d) * a, a * a])
    got = np.bincount(seat(np.full(draws, 3), np.full(draws, a), d, seeds, 2), minlength=4)[1:] / draws
    assert np.abs(got - share / share.sum()).max() < 0.015
    for n, opening, d in ((200, 0.05, 0.8), (200, 0.5, 0.7), (400, 3.0, 0.6), (1000, 0.01, 0.9)):  # beyond the exact ones the mean stays near
        log = ways(d, n)
        weight = np.arange(1, n + 1) * math.log(opening) + log[n, 1:]
        share = np.exp(weight - weight.max())
        mean = (share * np.arange(1, n + 1)).sum() / share.sum()
        got = seat(np.full(draws, n), np.full(draws, opening), d, seeds, 3).mean()
        assert n > EXACT and abs(got - mean) < 0.12 * mean, (n, opening, d, got, mean)


def test_predictive_probabilities_add_up():
    from musterline.llm.hpylm import CONCENTRATION, predictive, seat

    rng, d, above = np.random.default_rng(2), 0.7, 0.6
    n = rng.integers(0, 90, 50) * rng.integers(0, 2, 50)
    seeds = rng.integers(1, 1 << 60, 50).astype(np.uint64)
    c, tables = np.maximum(n // 2, 1), seat(n, np.full(50, 0.3), d, seeds, 1)
    up = seat(c, np.full(50, 0.2), above, seeds, 1)
    rest = (CONCENTRATION + above * up.sum()) / (CONCENTRATION + c.sum()) / 51
    base = np.maximum(c - above * up, 0) / (CONCENTRATION + c.sum()) + rest
    assert ((tables > 0) == (n > 0)).all() and (tables <= n).all()
    known = predictive(n, tables, n.sum(), tables.sum(), base, d).sum()
    assert math.isclose(known + predictive(0, 0, n.sum(), tables.sum(), rest, d), 1)


def test_scores_against_a_model_in_dictionaries(spark, monkeypatch):
    from musterline.llm import hpylm
    from musterline.llm.shared import mixed

    rng = random.Random(17)
    vocabulary = ["".join(rng.choices("abcde", k=rng.randint(1, 3))) for _ in range(40)]
    rows = [(i, " ".join(rng.choices(vocabulary, weights=range(40, 0, -1), k=rng.randint(0, 60)))) for i in range(60)] + [(7, "a b a b a b"), (None, "b a")]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows]
    one = lambda x: np.array([x], np.uint64)
    hashes = {b"": 0} | {w.encode(): int(hpylm.word_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)]))[0]) for w in vocabulary + ["a", "b"]}
    texts = [[b"", *t.encode().split(), b""] for _, t in rows]
    pairs = Counter(p for t, h in zip(texts, held) if not h for p in zip(t, t[1:]))
    n, follow, c0 = Counter(), Counter(), Counter()
    for (u, w), k in pairs.items():
        n[w] += k
        follow[u] += 1
        c0[w] += 1
    own = hpylm.discount_of(sum(k == 1 for k in pairs.values()), sum(k == 2 for k in pairs.values()))
    above = hpylm.discount_of(sum(k == 1 for k in c0.values()), sum(k == 2 for k in c0.values()))
    key = lambda u, w: mixed(mixed(one((hashes[u] + 0x9E3779B97F4A7C15) % (1 << 64))) ^ one(hashes[w] * 0xD6E8FEB86659FD93 % (1 << 64)))
    types, share, states, probability = len(n), None, [], {p: [] for t in texts for p in zip(t, t[1:])}
    for sweep in range(3):
        tables = dict.fromkeys(pairs, 1)
        if sweep:
            t, p, _ = states[-1]
            for (u, w), k in pairs.items():
                if k > 1:
                    tables[u, w] = int(hpylm.seat(np.array([k]), np.array([(1 + own * t[u]) * p[w]]), own, key(u, w), sweep)[0])
        c, rooms = Counter(), Counter()
        for (u, w), k in tables.items():
            c[w] += k
            rooms[u] += k
        up = {w: int(hpylm.seat(np.array([k]), np.array([share]), above, mixed(one(hashes[w])), sweep)[0]) if sweep else 1 for w, k in c.items()}
        rest = (1 + above * sum(up.values())) / (1 + sum(c.values())) / (types + 1)
        share = (1 + above * sum(up.values())) / (types + 1)
        states.append((rooms, {w: max(c[w] - above * up[w], 0) / (1 + sum(c.values())) + rest for w in c}, rest))
        if sweep:
            for u, w in probability:
                gain = max(pairs[u, w] - own * tables.get((u, w), 0), 0)
                probability[u, w].append((gain + (1 + own * rooms[u]) * states[-1][1].get(w, rest)) / (1 + n[u]))
    expected = Counter((i, round(sum(math.log10(sum(probability[p]) / 2) for p in zip(t, t[1:])), 3)) for (i, _), t in zip(rows, texts))
    for size in (hpylm.PIECE, 300):  # one piece, and many
        monkeypatch.setattr(hpylm, "PIECE", size)
        monkeypatch.setattr(hpylm, "PART", size)
        got = hpylm.score_documents(spark.createDataFrame(rows, "doc_id long, text string"))
        assert Counter((r["doc_id"], round(r["score"], 3)) for r in got.collect()) == expected


def test_similar_documents(spark, odd, none):
    from musterline.llm.simhash import long_segments, segments, shingled, similar_documents

    rng, texts = random.Random(21), []
    vocabulary = ["".join(rng.choices("abcdefg", k=6)) for _ in range(500)]
    for size in (8, 40, 40, 300, 300):
        base = rng.choices(vocabulary, k=size)
        texts.append(" ".join(base))
        for changes in (1, 1, 2, 3, 8):
            new = list(base)
            for at in rng.sample(range(size), min(size, changes * size // 100 + 1)):
                new[at] = rng.choice(vocabulary)
            texts.append(" ".join(new))
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()] + [(1000 + i, t) for i, t in enumerate(texts)]
    sets = [set(shingled((t or "").encode(), 5)) for _, t in rows]
    group = list(range(len(rows)))
    alike = lambda x, y: len(x & y) >= 0.8 * len(x | y)
    for _ in rows:
        group = [min(group[j] for j in range(len(rows)) if alike(sets[i], sets[j])) for i in range(len(rows))]
    low = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            low[g] = min(low.get(g, 1 << 60), i)
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(rows[-len(texts):], "doc_id long, text string"))
    got = Counter((r["doc_id"], r["component_id"]) for r in similar_documents(docs, recall=0.999).collect())
    assert got == Counter((i, low.get(g)) for (i, _), g in zip(rows, group))
    assert similar_documents(none).count() == 0
    for n in (1, 10**5, 10**8, 10**11):
        assert sum(r + 1 for _, _, r in segments(n)) > 4 and sum(w for _, w, _ in segments(n)) == 64
        assert len(long_segments(n, 0.8, 0.95)) > 4


def test_similar_pairs_at_defaults(spark):
    from musterline.llm.simhash import similar_documents

    rng, rows = random.Random(1), []
    vocabulary = ["".join(rng.choices("abcdefghijkl", k=7)) for _ in range(5000)]
    shingles = lambda words: {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    while len(rows) < 1000:
        base = rng.choices(vocabulary, k=rng.randint(150, 600))
        new, share = list(base), 1.0
        while share >= 0.81:
            new[rng.randrange(len(new))] = rng.choice(vocabulary)
            x, y = shingles(base), shingles(new)
            share = len(x & y) / len(x | y)
        if share >= 0.8:
            rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(new))]
    got = {r["doc_id"]: r["component_id"] for r in similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[i] == got[i + 1] for i in range(0, 1000, 2)) >= 475
    assert all(got[i] in (i, i - i % 2) for i in got)


def test_pairs_of_a_group_just_below_the_similarity(spark, monkeypatch):
    from musterline.llm import simhash

    rng = random.Random(31)
    vocabulary = ["".join(rng.choices("abcdefgh", k=7)) for _ in range(3000)]
    base, rows = rng.choices(vocabulary, k=200), []
    for i in range(150):  # pairs of them are about 0.66 alike
        words = list(base)
        for at in rng.sample(range(0, 200, 5), 4):
            words[at] = rng.choice(vocabulary)
        rows.append((i, " ".join(words)))
    rows += [(200 + i, rows[i][1] + " one two") for i in range(5)]
    sets = {i: simhash.distinct(simhash.shingled(t.encode(), 5)) for i, t in rows}
    for i, j in itertools.combinations(sets, 2):
        apart = np.bitwise_xor(simhash.sketch(sets[i]), simhash.sketch(sets[j])).view(np.uint64)
        assert sum(int(x).bit_count() for x in apart) <= len(np.setxor1d(sets[i], sets[j]))
    asked, check = [], simhash.alike

    def counted(pairs, *rest):
        asked.append(pairs.count())
        return check(pairs, *rest)

    monkeypatch.setattr(simhash, "alike", counted)
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), recall=0.999).collect()}
    group, links = {i: i for i in sets}, [(i, j) for i, j in itertools.combinations(sets, 2) if (n := len(np.intersect1d(sets[i], sets[j]))) >= 0.8 * (len(sets[i]) + len(sets[j]) - n)]
    for _ in range(len(rows)):
        for i, j in links:
            group[i] = group[j] = min(group[i], group[j])
    assert got == group and all(group[200 + i] == group[i] for i in range(5))
    assert sum(asked) < len(rows) * 5  # of 11,935 pairs


@pytest.mark.parametrize("most", [1, 7, 1000])
def test_pairs_in_cells(spark, most, monkeypatch):
    from musterline.llm import simhash

    monkeypatch.setattr(simhash, "CELL_SETS", most)
    rng = random.Random(5)
    sets = {i: rng.sample(range(-12, 12), rng.choice((0, 1, 5, 10, 18))) for i in range(40)}
    pairs = [(p, q, -p, -q) for p, q in itertools.permutations(sets, 2) if rng.random() < 0.6]
    near = lambda x, y: len(x & y) >= 0.5 * len(x | y)
    expected = Counter((a, b) for p, q, a, b in pairs if near(set(sets[p]), set(sets[q])))
    frames = spark.createDataFrame(pairs, "p long, q long, a long, b long"), spark.createDataFrame(list(sets.items()), "node long, set array<long>")
    assert Counter(tuple(r) for r in simhash.alike(*frames, 0.5).collect()) == expected
    assert simhash.alike(frames[0].limit(0), frames[1].limit(0), 0.5).count() == 0


@pytest.mark.parametrize("factor, least", [(1.0, 1.0), (0.7, 0.9)])
def test_nearest(spark, factor, least):
    from musterline.llm.vptree import nearest

    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8))
    vectors = (centres[rng.integers(0, 12, 900)] + 0.3 * rng.normal(size=(900, 8))).astype(np.float32)
    vectors[200:500] = vectors[200]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    rows += [(900, None, 0), (920, [0.0] * 8, 0), (940, [1.0, None] + [0.0] * 6, 0), (960, [float("nan")] * 8, 0), (None, [1.0] * 8, 0), (980, [1.0] * 3, 0), (5, vectors[5].tolist(), 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = {}
    for r in nearest(table, factor=factor).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 900, 20))
    exact = vectors.astype(np.float64)
    hits = 0
    for q, found in got.items():
        score = np.zeros(900)
        for j in range(8):
            score += exact[q, j] * exact[:, j]
        order = [int(i) for i in np.lexsort((np.arange(900), -score)) if i != q][:20]
        found.sort()
        hits += len(set(order) & {v for _, v, _ in found})
        if factor == 1:
            assert [(v, s) for _, v, s in found] == [(i, score[i]) for i in order]
    assert hits >= least * 20 * len(got)
    assert nearest(table.limit(0)).count() == 0


@pytest.mark.parametrize("long", [None, 1e18, 1e38])
def test_nearest_of_ties_and_of_very_long_vectors(spark, long):
    from musterline.llm.vptree import nearest

    if long is None:
        vectors = np.eye(100)[np.random.default_rng(6).permutation(100)]
    else:
        vectors = np.random.default_rng(5).normal(size=(2000, 8)).astype(np.float32).astype(np.float64)
        vectors[1999] *= long
    got = {}
    for r in nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    for q in range(0, len(vectors), 20):
        score = np.zeros(len(vectors))
        for j in range(vectors.shape[1]):
            score += vectors[q, j] * vectors[:, j]
        assert got[q] == [int(i) for i in np.lexsort((np.arange(len(score)), -score)) if i != q][:20]


def brute_repeats(rows, window=20):
    seen, out = set(), {}
    for i, text in sorted({(r["doc_id"], r["text"]) for r in rows if r["doc_id"] is not None}, key=lambda x: x[0]):
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            seen.add(key)
        out[i] = len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()
    return out


def test_substrings(spark, odd, none, monkeypatch):
    from musterline.llm import rlz

    for size in (8.0, 0.002):  # one bucket, and very many
        monkeypatch.setattr(rlz, "BUCKET_MB", size)
        rows, got = odd.collect(), rlz.substring_dedup(odd, carry=odd.columns, joined=True).collect()
        assert len(got) == len(rows)
        expected = brute_repeats(rows)
        for r in got:
            if r["doc_id"] is not None:
                assert (r["n_words"], r["n_removed"], r["kept"]) == expected[r["doc_id"]] and sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
            else:
                assert (r["n_words"], r["n_removed"]) == (30, 0)
        plain = {r["doc_id"]: r for r in rlz.substring_dedup(odd, carry=["text"]).collect()}
        assert all(r["kept"] == r["row"]["text"] for r in plain.values() if not r["n_removed"] and r["n_words"])
        assert rlz.substring_dedup(none).count() == 0


def test_pipeline(spark, odd, none):
    import corpus_pipeline

    docs = odd
    for _, stage in corpus_pipeline.STAGES:
        new = stage(spark, docs, SF).cache()
        assert stage(spark, none, SF).count() == 0
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert new.columns == docs.columns
        docs = new
    ids = {r["doc_id"] for r in docs.collect()}
    assert ids.isdisjoint({0, 1, 2, 3}) and 4 in ids
    assert corpus_pipeline.run(spark, SF).count() > 100


def test_stages_against_brute_force(spark, odd):
    import corpus_pipeline as pipeline
    from public_tokenizers import path
    from tokenizers import Tokenizer

    from musterline.llm.mixing import mix
    from musterline.llm.simhash import shingled

    docs = odd.union(documents(spark, [(None, "null one two three four five six", "en", "a", 1), (None, "null " * 9, "en", "a", 1), (4, "a second text of one id " * 3, "en", "a", 1)]))
    rows = docs.collect()
    row = lambda r: (r["doc_id"], r["text"], r["source"])

    kept = Counter(map(row, pipeline.known_language(spark, docs, SF).collect()))
    assert not kept - Counter(map(row, rows)) and all(t and any(c.isalpha() for c in t) for _, t, _ in kept)

    sets = [set(shingled((r["text"] or "").encode(), 5)) for r in rows]
    group = list(range(len(rows)))
    for _ in rows:
        group = [min(group[j] for j in range(len(rows)) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])) for i in range(len(rows))]
    low, stays = {}, {}
    for r, g in zip(rows, group):
        if r["doc_id"] is not None:
            low[g] = min(low.get(g, 1 << 60), r["doc_id"])
    for r, g in zip(rows, group):
        stays[r["doc_id"]] = stays.get(r["doc_id"], False) or r["doc_id"] == low.get(g)
    assert Counter(map(row, pipeline.one_of_each(spark, docs, SF).collect())) == Counter(row(r) for r in rows if stays[r["doc_id"]])

    expected = brute_repeats([r for r in rows if r["doc_id"] != 4])
    got = Counter((r["doc_id"], " ".join(w.decode() for w in words(r["text"]))) for r in pipeline.without_repeats(spark, docs.where("doc_id <> 4"), SF).collect())
    alike = Counter(r["doc_id"] for r in rows)
    assert got == Counter({(i, text): alike[i] for i, (n, gone, text) in expected.items() if gone < n or not gone})

    size, taken = Counter(), Counter()
    for r in rows:
        size[r["source"]] += len(words(r["text"]))
    target = {r["source"]: r["target"] for r in mix(docs).collect()}
    out = pipeline.mixed_sources(spark, docs, SF).collect()
    copies = Counter(map(row, out))
    for (_, text, source), n in copies.items():
        taken[source] += n * len(words(text))
    longest = {s: max(len(words(r["text"])) for r in rows if r["source"] == s) for s in size}
    repeated = sum(len(words(r["text"])) for r in rows if r["doc_id"] == 50)  # alike rows get the largest number of copies among them
    assert all(abs(taken[s] - target[s]) <= longest[s] + repeated for s in size)
    assert all(n <= 3 * Counter(map(row, rows))[x] for x, n in copies.items())

    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    ids = {r["doc_id"]: r["ids_sha256"] for r in pipeline.encoded(spark, docs.where("doc_id > 4"), SF).collect()}
    for r in rows:
        if r["doc_id"] is not None and r["doc_id"] > 4:
            found = library.encode(r["text"], add_special_tokens=False).ids
            assert ids[r["doc_id"]] == hashlib.sha256(" ".join(map(str, found)).encode()).hexdigest()
