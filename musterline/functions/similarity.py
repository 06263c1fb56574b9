"""Name similarity on UTF-8 bytes: unigram measures as column expressions, edit measures as Arrow-batched UDFs.

The edit UDFs are the only Python here: Spark has no Jaro-Winkler or restricted Damerau distance and no Soundex that
keeps a leading digit. Jaro-Winkler runs over all pairs of a batch at once, byte by byte; the others once per distinct value.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _counts(a: Column, b: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of the array of (count in a, count in b) over the bytes of either."""
    parts = lambda c: F.regexp_extract_all(F.hex(F.encode(c, "UTF-8")), F.lit("(..)"), 1)
    number = lambda array, x: F.size(F.filter(array, lambda y: y == x))
    pair = F.struct(parts(a).alias("a"), parts(b).alias("b"))
    counted = F.transform(F.array(pair), lambda p: F.transform(F.array_union(p["a"], p["b"]), lambda x: F.struct(number(p["a"], x).alias("a"), number(p["b"], x).alias("b"))))
    return F.when(a.isNotNull() & b.isNotNull(), F.transform(counted, then)[0])


def _sum(array: Column, f: Callable[[Column], Column]) -> Column:
    return F.aggregate(array, F.lit(0).cast("double"), lambda s, x: s + f(x).cast("double"))


def cosine(a: Column, b: Column) -> Column:
    norm = lambda t, k: F.sqrt(_sum(t, lambda x: x[k] * x[k]))
    share = lambda t: F.try_divide(_sum(t, lambda x: x["a"] * x["b"]), norm(t, "a") * norm(t, "b"))
    return _counts(a, b, lambda t: F.when(F.size(t) == 0, 0.0).otherwise(F.greatest(F.lit(0.0), 1 - F.coalesce(share(t), F.lit(0.0)))))


def qgram(a: Column, b: Column) -> Column:
    return _counts(a, b, lambda t: _sum(t, lambda x: F.abs(x["a"] - x["b"])))


def jaccard(a: Column, b: Column) -> Column:
    """One minus the share of common bytes, each counted as often as it stands."""
    low, high = (lambda t, f=f: _sum(t, lambda x: f(x["a"], x["b"])) for f in (F.least, F.greatest))
    return _counts(a, b, lambda t: F.coalesce(1 - F.try_divide(low(t), high(t)), F.lit(0.0)))


def jaro_winkler(a: bytes, b: bytes) -> float:
    """Distance; half transpositions count, up to four equal first bytes help by a tenth each, whatever the similarity."""
    if not a or not b:
        return 0.0 if a == b else 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken, mine = [False] * len(b), []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == x:
                taken[j] = True
                mine.append(x)
                break
    m = len(mine)
    if not m:
        return 1.0
    moved = sum(x != y for x, y in zip(mine, (y for y, t in zip(b, taken) if t))) / 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(4, len(a), len(b)))
    return 1 - (jaro + prefix * 0.1 * (1 - jaro))


def osa(a: bytes, b: bytes) -> int:
    """Edits where two neighbours may be swapped once."""
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            best = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, older[j - 2] + 1)
            row.append(best)
    return row[-1]


# Soundex digit groups.
_DIGITS = {ord(c): str(d) for d, group in enumerate(("BFPV", "CGJKQSXZ", "DT", "L", "MN", "R"), 1) for c in group}


def soundex(s: bytes) -> str:
    """American Soundex whose first place keeps any byte."""
    s = s.upper()
    if not s:
        return ""
    out, last = chr(s[0]), _DIGITS.get(s[0])
    for c in s[1:]:
        digit = _DIGITS.get(c)
        if digit and digit != last:
            out += digit
        if c not in b"HW":
            last = digit
    return (out + "000")[:4]


def padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts as rows of bytes, zero after their ends, and their lengths."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    wide = max(1, int(sizes.max(initial=0)))
    return np.frombuffer(b"".join(t.ljust(wide, b"\0") for t in texts), np.uint8).reshape(len(texts), wide), sizes


WIDE = 64  # bytes of a text whose places fit the bits of one number
BELOW = np.array([(1 << k) - 1 for k in range(WIDE + 1)], np.uint64)


def _taken_bits(x: np.ndarray, nx: np.ndarray, b: list[bytes], ny: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which places of each first text have a partner, and the partners' places in the second as bits.

    The places of a byte in a second text are one number, so each step takes the lowest free place in reach of all pairs at once.
    """
    known = {t: i for i, t in enumerate(dict.fromkeys(b))}
    which = np.fromiter((known[t] for t in b), np.int64, len(b))
    rows = np.repeat(np.arange(len(known)), [len(t) for t in known])
    codes = np.frombuffer(b"".join(known), np.uint8)
    places = np.concatenate([np.arange(len(t)) for t in known]) if known else np.zeros(0, np.int64)
    at = np.zeros((len(known), 256), np.uint64)
    np.bitwise_or.at(at, (rows, codes), np.uint64(1) << places.astype(np.uint64))
    free, hit, one = BELOW[ny], np.zeros(x.shape, bool), np.uint64(1)
    for i in range(x.shape[1]):
        window = BELOW[np.clip(i + reach + 1, 0, WIDE)] & ~BELOW[np.clip(i - reach, 0, WIDE)]
        found = np.where(i < nx, at[which, x[:, i]] & free & window, np.uint64(0))
        first = found & (~found + one)
        hit[:, i] = first != 0
        free = free ^ first
    return hit, BELOW[ny] ^ free


def winkler(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Jaro-Winkler distances of pairs, the same as ``jaro_winkler`` gives one by one."""
    long = np.fromiter((len(t) > WIDE for t in b), bool, len(b))
    if long.any():
        out = np.zeros(len(a))
        out[long] = [jaro_winkler(a[i], b[i]) for i in np.flatnonzero(long)]
        rest = np.flatnonzero(~long)
        out[rest] = winkler([a[i] for i in rest], [b[i] for i in rest])
        return out
    (x, nx), (y, ny) = padded(a), padded(b)
    hit, bits = _taken_bits(x, nx, b, ny, np.maximum(np.maximum(nx, ny) // 2 - 1, 0))
    taken = ((bits[:, None] >> np.arange(y.shape[1], dtype=np.uint64)[None, :]) & np.uint64(1)).astype(bool)
    m = hit.sum(axis=1)
    left, right = (np.zeros((len(a), max(1, int(m.max(initial=0)))), np.uint8) for _ in range(2))
    for out, codes, mask in ((left, x, hit), (right, y, taken)):
        r, c = np.nonzero(mask)
        out[r, np.arange(len(r)) - np.repeat(np.cumsum(m) - m, m)] = codes[r, c]
    moved = (left != right).sum(axis=1) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / nx + m / ny + (m - moved) / m) / 3, 0.0)
    k = min(4, x.shape[1], y.shape[1])
    equal = (x[:, :k] == y[:, :k]) & (np.arange(k)[None, :] < np.minimum(nx, ny)[:, None])
    prefix = np.logical_and.accumulate(equal, axis=1).sum(axis=1)
    return np.where((nx == 0) & (ny == 0), 0.0, np.where(m > 0, 1 - (jaro + prefix * 0.1 * (1 - jaro)), 1.0))


STEP = 8192  # pairs compared at once


def _scored(a: pd.Series, b: pd.Series) -> tuple[np.ndarray, np.ndarray, list, list]:
    """Which pairs are whole, their Jaro-Winkler distances, and their sides as bytes."""
    whole = (a.notna() & b.notna()).to_numpy()
    x, y = ([t.encode() for t in s[whole]] for s in (a, b))
    distance = np.full(len(a), np.nan)
    parts = [winkler(x[i : i + STEP], y[i : i + STEP]) for i in range(0, len(x), STEP)]
    distance[whole] = np.concatenate(parts) if parts else []
    return whole, distance, x, y


def _codes(values: list[bytes]) -> list[str]:
    known = {v: soundex(v) for v in set(values)}
    return [known[v] for v in values]


def _unlike(x: list[bytes], y: list[bytes]) -> list[int]:
    return [int(not (p and q and c == d)) for p, q, c, d in zip(x, y, _codes(x), _codes(y))]


SOUNDS = T.StructType([T.StructField("jw", T.DoubleType()), T.StructField("soundex", T.IntegerType())])
EDITS = T.StructType([T.StructField("jw", T.DoubleType()), T.StructField("osa", T.IntegerType()), T.StructField("soundex", T.IntegerType())])


@F.pandas_udf(SOUNDS)
def sounds(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Jaro-Winkler distance and whether Soundex codes differ; null if either side is null."""
    whole, distance, x, y = _scored(a, b)
    out = pd.DataFrame({"jw": distance, "soundex": pd.array([None] * len(a), "Int32")})
    out.loc[whole, "soundex"] = _unlike(x, y)
    return out


@F.pandas_udf(EDITS)
def edits(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Jaro-Winkler distance, restricted Damerau distance, and whether Soundex codes differ; null if either side is null."""
    whole, distance, x, y = _scored(a, b)
    known = {pair: osa(*pair) for pair in set(zip(x, y))}
    out = pd.DataFrame({"jw": distance, "osa": pd.array([None] * len(a), "Int32"), "soundex": pd.array([None] * len(a), "Int32")})
    out.loc[whole, "osa"], out.loc[whole, "soundex"] = [known[p] for p in zip(x, y)], _unlike(x, y)
    return out


SIGNS = T.StructType([T.StructField("low", T.LongType()), T.StructField("high", T.LongType()), T.StructField("more", T.IntegerType()), T.StructField("size", T.IntegerType()), T.StructField("head", T.LongType()), T.StructField("soundex", T.StringType())])
SLACK = 1e-9  # more than rounding can move a distance
LEVELS = 4  # occurrences of a byte class that a signature tells apart


def signature(name: bytes) -> tuple[int, int, int, int, int, str]:
    """What two names are compared by before their letters are: bytes by class, length, first bytes, Soundex.

    A byte's class is its value modulo 32. Of each class, occurrence k < 4 sets the bit 32 k + class of 128 (``low`` and ``high``), so
    bits that two names share count the bytes they may have in common; ``more`` counts the bytes beyond those.
    """
    bits, more, seen = 0, 0, [0] * 32
    for c in name:
        c &= 31
        if seen[c] < LEVELS:
            bits |= 1 << (32 * seen[c] + c)
        else:
            more += 1
        seen[c] += 1
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return signed(bits & ((1 << 64) - 1)), signed(bits >> 64), more, len(name), int.from_bytes(name[:4].ljust(4, b"\0"), "big"), soundex(name)


@F.pandas_udf(SIGNS)
def signs(names: pd.Series) -> pd.DataFrame:
    """``signature`` of each name, once per distinct name; null of null."""
    known = {n: signature(n.encode()) for n in names.dropna().unique()}
    columns = zip(*[known.get(n, (None,) * 6) for n in names]) if len(names) else [()] * 6
    kinds = ("Int64", "Int64", "Int32", "Int32", "Int64", "object")
    return pd.DataFrame({c: pd.array(list(v), kind) for c, v, kind in zip(SIGNS.names, columns, kinds)})  # nulls must not make floats of the bits


def least_distance(a: Column, b: Column) -> Column:
    """No Jaro-Winkler distance of two names is smaller than this, from their signatures alone; it stays in the JVM.

    Matches are at most the bytes in common; with all of them in order the similarity of names of n and k bytes is
    (m / n + m / k + 1) / 3, and equal first bytes help as they would.
    """
    shared = F.bit_count(a["low"].bitwiseAND(b["low"])) + F.bit_count(a["high"].bitwiseAND(b["high"])) + F.least(a["more"], b["more"])
    m = F.least(shared, a["size"], b["size"]).cast("double")
    differ = a["head"].bitwiseXOR(b["head"])
    prefix = F.when(differ == 0, 4).when(differ < 1 << 8, 3).when(differ < 1 << 16, 2).when(differ < 1 << 24, 1).otherwise(0)
    jaro = (m / a["size"] + m / b["size"] + 1) / 3
    whole = (1 - jaro) * (1 - 0.1 * prefix)
    return F.when((a["size"] == 0) | (b["size"] == 0), F.when(a["size"] == b["size"], 0.0).otherwise(1.0)).when(m == 0, 1.0).otherwise(whole)


def spellings(name: Column) -> Column:
    """Hashes of a name's bytes in any order: of all, and of all but each one. Names with at most one byte each that the other lacks have one in common."""
    codes = F.transform(F.regexp_extract_all(F.hex(F.encode(name, "UTF-8")), F.lit("(..)"), 1), lambda x: F.xxhash64(x))
    whole = F.aggregate(codes, F.lit(0).cast("long"), lambda h, x: h.bitwiseXOR(x))
    pair = F.struct(whole.alias("whole"), codes.alias("codes"))
    return F.transform(F.array(pair), lambda p: F.array_distinct(F.concat(F.array(p["whole"]), F.transform(p["codes"], lambda x: p["whole"].bitwiseXOR(x)))))[0]


def least_unspelled(name: Column) -> Column:
    """No name that has none of its ``spellings`` in common with this one is nearer by Jaro-Winkler.

    One of the two has two bytes more than they share, so of names of n and k bytes with m in common (n - m) / n + (k - m) / k is at
    least 2 / (n + 2); the distance is a third of that, or 0.6 of the third with four equal first bytes.
    """
    return 0.4 / (F.octet_length(name) + F.lit(2))


def likeness(a: Column, b: Column) -> Column:
    """All measures of two names and their sum, as one struct; null if either name is null."""
    e = edits(a, b)
    parts = {"osa": e["osa"], "qgram": qgram(a, b), "cosine": cosine(a, b), "jaccard": jaccard(a, b), "jw": e["jw"], "soundex": e["soundex"]}
    total = sum((c.cast("double") for c in list(parts.values())[1:]), parts["osa"].cast("double"))
    return F.when(a.isNotNull() & b.isNotNull(), F.struct(*[c.alias(k) for k, c in parts.items()], total.alias("score_sums")))
