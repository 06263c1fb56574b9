"""SimHash near-duplicate detection with multi-index hashing.

A fingerprint bit is the majority of that bit over the XXH64 hashes of all word shingles of the text, after lower-casing
A-Z; further words of a longer fingerprint come from further seeds. ``near_duplicates`` links fingerprints at most
``distance`` bits apart; ``similar_documents`` takes longer fingerprints and links texts whose sets of shingles are as
similar as asked. Documents that links connect form one component. No bucket is capped: inside each table bucket a
star of links to one centre joins what it can first, and the exact join that follows only emits pairs that are still apart
and leaves out buckets of one component.
"""

from __future__ import annotations

from functools import partial, reduce
from itertools import accumulate
from math import acos, ceil, comb, log2, pi

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, erased, maybe_among, mixed, release, saved, text_of

SHINGLE = 4
DISTANCE = 4
SEED = 42
BITS = 64
WORDS = 6  # of a fingerprint at least where texts are compared by similarity
ROUNDS, CENTRES = 2, 8  # of stars, before texts that are still apart are compared in pairs
SKETCH = 4  # words of the parities of a set, which bound how many shingles two sets do not share
SPREAD = 4  # standard deviations of bits that candidates may differ by beyond the mean of pairs right at the similarity
TURN = 4  # segments whose buckets are joined at once, as shuffles of all of them would fill the disk
CELL_SETS, CELL_VALUES = 1000, 1 << 19  # sets, and values in them, on each side of a cell of pairs


def shingled(text: bytes, shingle: int) -> list[bytes]:
    """All shingles of a text, repeats included; of fewer words the whole sequence, of none nothing."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [joined]
    ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
    return [joined[s:e] for s, e in zip([0, *[x + 1 for x in ends]], ends[shingle - 1 :])]


def hashed(parts: list[bytes], seed: int) -> np.ndarray:
    """Big-endian digests of the parts as rows of bytes."""
    import xxhash

    return np.frombuffer(b"".join(map(partial(xxhash.xxh64_digest, seed=seed), parts)), np.uint8).reshape(-1, 8)


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one whole text; a text without words has zero."""
    parts = shingled(text, shingle)
    return majority(parts, seed) if parts else 0


def majority(parts: list[bytes], seed: int) -> int:
    total, n = np.zeros(BITS, np.int64), len(parts)
    for low in range(0, n, 8192):
        total += np.unpackbits(hashed(parts[low : low + 8192], seed), axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def distinct(parts: list[bytes]) -> np.ndarray:
    """The set of the shingles' 64-bit hashes, in order."""
    return np.unique(hashed(parts, SEED).copy().view(np.int64)) if parts else np.zeros(0, np.int64)


def sketch(values: np.ndarray) -> np.ndarray:
    """Of each of ``SKETCH`` times 64 classes of hashes, whether a set has an odd number.

    What two sets share cancels out, so their sketches differ in no more bits than the sets do in values.
    """
    odd = np.bincount(mixed(values.astype(np.uint64)) % np.uint64(SKETCH * BITS), minlength=SKETCH * BITS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, words: int = 0) -> DataFrame:
    """(id, key, fp): a hash of the text and a signed 64-bit fingerprint per row, or with ``words`` an array of so many, and (sketch, size) of the set of shingles.

    Null text counts as empty.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    source = source.select("id", F.xxhash64("text", F.octet_length("text")).alias("key"), F.col("text").cast("binary").alias("t"))

    def work(batches):
        import pyarrow as pa

        for batch in batches:
            rows = batch.num_rows
            found, sketches, sizes = np.zeros((rows, max(1, words)), np.uint64), np.zeros((rows, SKETCH), np.int64), np.zeros(rows, np.int64)
            for i, x in enumerate(batch.column(2)):
                parts = shingled(x.as_py() or b"", shingle)
                if parts:
                    found[i] = [majority(parts, SEED + j) for j in range(max(1, words))]
                if parts and words:
                    values = distinct(parts)
                    sketches[i], sizes[i] = sketch(values), len(values)
            release()
            lists = lambda x, rows=rows: pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel().view(np.int64)))
            out = [("fp", lists(found)), ("sketch", lists(sketches)), ("size", pa.array(sizes))] if words else [("fp", pa.array(found.ravel().view(np.int64)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[x for _, x in out]], names=["id", "key", *[n for n, _ in out]])

    return source.mapInArrow(work, "id long, key long, " + ("fp array<long>, sketch array<long>, size long" if words else "fp long"))


def segments(n: int, distance: int = DISTANCE, bits: int = BITS) -> list[tuple[int, int, int]]:
    """(lowest bit, width, radius) of the segments that find all pairs of ``n`` fingerprints within ``distance`` bits.

    If m segments all differed by more than their radius, the whole would differ by more than ``distance``; the radii
    are therefore as even as possible and add up to ``distance`` - m + 1. Of all m, the one with the least work is taken:
    keys of a fingerprint, and others met in its buckets, of which a corpus has more than random bits would.
    """
    best = None
    for m in range(1, distance + 2):
        radii = [(distance - m + 1) // m + (i < (distance - m + 1) % m) for i in range(m)]
        widths = [bits // m + (i < bits % m) for i in range(m)]
        balls = [sum(comb(w, r) for r in range(radius + 1)) for w, radius in zip(widths, radii)]
        work = sum(balls) + 8 * n * sum(b / 2**w for b, w in zip(balls, widths))
        if best is None or work < best[0]:
            best = work, [(sum(widths[:i]), w, r) for i, (w, r) in enumerate(zip(widths, radii))]
    return best[1]


def share_of_bits(similarity: float) -> float:
    """Expected share of differing bits of two sets of that Jaccard similarity: their angle over pi."""
    return acos(2 * similarity / (1 + similarity)) / pi


def long_segments(n: int, similarity: float, recall: float) -> list[tuple[int, int, int]]:
    """Segments of radius one, as wide as suits ``n``, and so many that ``recall`` of the pairs of that similarity share one within its radius."""
    width = max(14, min(28, ceil(log2(max(2, n))) - 6))
    p = share_of_bits(similarity)
    miss = 1 - (1 - p) ** width - width * p * (1 - p) ** (width - 1)
    count = 1
    while miss**count > 1 - recall:
        count += 1
    return [(i * width, width, 1) for i in range(count)]


def ball(width: int, radius: int) -> list[int]:
    """Every mask of ``width`` bits with at most ``radius`` bits set."""
    masks = [0]
    for _ in range(radius):
        masks = sorted({m | 1 << b for m in masks for b in range(width)} | set(masks))
    return masks


def cut(words: list[str], low: int, width: int):
    """Bits ``low`` .. ``low`` + ``width`` of a fingerprint in columns of 64 bits, also across two of them."""
    at, shift = divmod(low, BITS)
    part = F.shiftrightunsigned(words[at], shift)
    if shift + width > BITS:
        part = part.bitwiseOR(F.shiftleft(words[at + 1], BITS - shift))
    return part.bitwiseAND(F.lit((1 << width) - 1))


def keys(nodes: DataFrame, words: list[str], balls: bool, parts: list[tuple[int, int, int]], turn: range | None = None) -> DataFrame:
    """One row per node, segment (of those in ``turn``) and (with ``balls``) mask of half its Hamming ball; k holds segment and bits.

    Of two nodes that differ by a mask, one has 0 and one has 1 at its lowest bit; the one that has 0 takes the mask, so they meet once.
    """
    which = turn or range(len(parts))
    codes = [i << 32 | m for i in which for m in (ball(*parts[i][1:]) if balls else [0])]
    # one literal list and one expression for all masks: a method of a case for each would be too long for the JVM to compile
    x, part = F.col("__code"), F.lit(None).cast("long")
    for i in which:
        part = F.when(F.shiftright(x, 32) == i, cut(words, *parts[i][:2])).otherwise(part)
    m = x.bitwiseAND(F.lit(0xFFFFFFFF))
    met = nodes.withColumn("__code", F.explode(F.lit(codes).cast("array<long>"))).where(part.bitwiseAND(m.bitwiseAND(-m)) == 0)
    return met.select(*nodes.columns, part.bitwiseXOR(x).alias("k"))


def linked(prints: DataFrame, distance: int = DISTANCE, parts: list[tuple[int, int, int]] | None = None, words: int = 0, check=None, rounds: int = 1, centres: int = 1, near: int | None = None, similarity: float | None = None) -> DataFrame:
    """(fp, root) for every distinct fingerprint; fingerprints of one component have one root.

    A node stands for a fingerprint: itself, or of a fingerprint of several ``words`` its 64-bit hash. In each of ``rounds``
    every node meets ``centres`` others of each of its buckets, drawn anew, and those at most ``near`` bits apart join; what
    comes then is exact. ``check`` takes pairs of nodes (p, q, ..) with all nodes (node, fp), and leaves the pairs that are linked.
    With ``similarity``, prints also hold (key, sketch, size), and pairs that are surely less alike go before they are checked.
    """
    single, own = not words, [f"w{i}" for i in range(max(1, words))]
    odd = [] if similarity is None else [f"s{i}" for i in range(SKETCH)]
    nodes = prints.groupBy("fp").agg(F.count("*").alias("n"), *([F.min_by(F.struct("sketch", "size"), "key").alias("of")] if odd else []))
    more = [F.col("of.sketch")[i].alias(s) for i, s in enumerate(odd)] + ([F.col("of.size").alias("size")] if odd else [])
    nodes = saved(nodes.select("fp", (F.col("fp") if single else F.xxhash64("fp")).alias("node"), *[(F.col("fp") if single else F.col("fp")[i]).alias(w) for i, w in enumerate(own)], *more))
    parts = parts or segments(nodes.count(), distance)
    check = check or (lambda pairs, nodes: pairs)
    other = [f"o{i}" for i in range(len(own))]
    differ = lambda xs, ys: sum((F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(xs[1:], ys[1:])), F.bit_count(F.col(xs[0]).bitwiseXOR(F.col(ys[0]))))
    apart, possible, body = differ(own, other), F.lit(True), own + [c for c in nodes.columns if c in (*odd, "size")]
    others = other + [f"o_{c}" for c in body[len(own) :]]
    if odd:  # sets of n and k values with d that only one has are (n + k - d) / (n + k + d) alike
        least = F.greatest(differ(odd, [f"o_{s}" for s in odd]), F.abs(F.col("size") - F.col("o_size")))
        possible = least * F.lit(1 + similarity) <= (F.col("size") + F.col("o_size")) * F.lit(1 - similarity) + F.lit(1e-6)
    named = nodes.select("fp", F.col("node").alias("p"), *body, F.col("node").alias("a"))

    def joined(pairs: DataFrame) -> DataFrame:
        """The nodes with their labels after pairs (p, q, a, b) are linked."""
        found = components(check(pairs, nodes).select("a", "b").distinct())
        return saved(named.join(found, named.a == found.node, "left").select("fp", "p", *body, F.coalesce("root", "a").alias("a")))

    for turn in range(rounds):
        table = keys(named, own, False, parts)
        whole = F.struct("p", "a", *body)
        drawn = table.groupBy("k").agg(F.array_distinct(F.array(*[F.min_by(whole, F.xxhash64("p", "k", F.lit(turn * centres + i))) for i in range(centres)])).alias("c"))
        drawn = drawn.select("k", F.explode("c").alias("c")).select("k", F.col("c.p").alias("q"), F.col("c.a").alias("b"), *[F.col(f"c.{w}").alias(o) for w, o in zip(body, others)])
        stars = table.join(drawn.hint("merge"), "k").where((F.col("a") != F.col("b")) & (apart <= (distance if near is None else near)) & possible)
        named = joined(stars.select("p", "q", "a", "b").distinct())

    def met(turn: range) -> DataFrame:
        """Pairs of nodes still apart that share a segment of the turn, each once.

        Which segment is a pair's first is not asked in the join: with it the join's code was over the 8,000 bytes that the JVM compiles, and each pair
        was interpreted.
        """
        # keys are many times the rows that Spark's estimate of them is made from, so their joins are never broadcast
        left = keys(named, own, True, parts, turn).select("k", "p", "a", *body)
        right = keys(named, own, False, parts, turn).select(F.col("k").alias("k2"), F.col("p").alias("q"), F.col("a").alias("b"), *[F.col(w).alias(o) for w, o in zip(body, others)])
        reach = right.groupBy(F.col("k2").alias("k3")).agg(F.min("b").alias("low"), F.max("b").alias("high"))
        left = left.join(reach.hint("merge"), F.col("k") == F.col("k3")).where((F.col("a") != F.col("low")) | (F.col("a") != F.col("high"))).drop("k3", "low", "high")
        pairs = left.join(right.hint("merge"), (F.col("k") == F.col("k2")) & (F.col("a") != F.col("b")) & (apart <= distance) & possible)
        ahead = F.col("p") < F.col("q")
        ends = [F.when(ahead, F.col(x)).otherwise(F.col(y)).alias(x) for x, y in ("pq", "qp", "ab", "ba")]
        return (pairs.select("a", "b") if single else pairs.select(*ends)).distinct()

    turns = [range(i, min(i + TURN, len(parts))) for i in range(0, len(parts), TURN)]
    if len(turns) == 1:
        return joined(met(turns[0])).select("fp", F.col("a").alias("root"))
    found = []
    for turn in turns:
        found.append(saved(met(turn)))
        erased(prints.sparkSession)  # the shuffles of this turn
    result = joined(reduce(DataFrame.union, found).distinct()).select("fp", F.col("a").alias("root"))
    erased(prints.sparkSession, *found)
    return result


def grouped(prints: DataFrame, roots: DataFrame) -> DataFrame:
    """``prints`` with component_id, the smallest id of the component."""
    members = saved(prints.groupBy("fp").agg(F.min("id").alias("low")).join(roots, "fp"))
    smallest = saved(members.groupBy("root").agg(F.min("low").alias("component_id")))  # written, so that a large component's join may be split
    return prints.join(members.select("fp", "root").join(smallest, "root").select("fp", "component_id"), "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (signed long), fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest id reachable over links of at most ``distance`` differing bits. Null and
    empty texts have fingerprint zero and link like any other. Repeated rows stay, each with the same result;
    rows with a null id take part and get their component's smallest id (null if it has none). An empty
    table gives no rows; other columns of ``docs`` are not read.
    """
    prints = saved(fingerprints(docs, id_col, text_col, shingle).select("id", "fp"))
    return grouped(prints, linked(prints, distance)).select(
        F.col("id").alias("doc_id"), "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of those ``pairs`` (p, q, a, b) whose sets (node, set of distinct longs) have at least that Jaccard similarity.

    Pairs lie in a square of cells by the hashes of both nodes, and a set goes once to each cell that asks for it, not with each
    of its pairs. There are so many cells that none gets more than about ``CELL_SETS`` sets and ``CELL_VALUES`` values a side.
    """
    n, values = sets.agg(F.count("*"), F.coalesce(F.sum(F.size("set").cast("long")), F.lit(0))).first()
    side = max(n // CELL_SETS, values // CELL_VALUES) + 1
    row, column = F.pmod(F.xxhash64("p"), F.lit(side)), F.pmod(F.xxhash64("q", F.lit(1)), F.lit(side))
    pairs = pairs.select("p", "q", "a", "b", (row * side + column).alias("cell"))
    asks = pairs.select(F.col("cell").alias("of"), F.col("p").alias("node")).union(pairs.select("cell", "q")).distinct()
    needed = asks.join(sets, "node").select("of", "node", "set")

    def compared(left, right):
        import pyarrow as pa

        lists = pa.concat_arrays(right.column("set").chunks)
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.append(0, np.cumsum(sizes))
        words, ids = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
        nodes = right.column("node").to_numpy()
        order = np.argsort(nodes)
        p, q = (order[np.searchsorted(nodes, left.column(c).to_numpy(), sorter=order)] for c in "pq")
        by, linked, held = np.argsort(p, kind="stable"), np.zeros(left.num_rows, bool), np.zeros(len(words), bool)
        for rows in np.split(by, np.flatnonzero(np.diff(p[by])) + 1):
            own, others = p[rows[0]], q[rows]
            mine = ids[starts[own] : starts[own + 1]]
            held[mine] = True
            ends = np.cumsum(sizes[others])
            at = np.arange(ends[-1]) + np.repeat(starts[others] - ends + sizes[others], sizes[others])
            seen = np.append(0, np.cumsum(held[ids[at]]))
            shared = seen[ends] - seen[ends - sizes[others]]
            linked[rows] = shared >= similarity * (sizes[own] + sizes[others] - shared)
            held[mine] = False
        release()
        return left.select(["a", "b"]).filter(pa.array(linked))

    return pairs.groupBy("cell").cogroup(needed.groupBy("of")).applyInArrow(compared, "a long, b long")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, recall: float = 0.98) -> DataFrame:
    """One row per row of ``docs``: doc_id, component_id.

    Links are pairs of texts whose sets of ``shingle``-word shingles have a Jaccard similarity of at least ``similarity``,
    compared as 64-bit hashes. Candidates share a segment of long fingerprints but for one bit, and differ by at most ``SPREAD``
    standard deviations more bits than pairs of ``similarity`` do, which leaves out about one such pair in 30,000; those whose sizes or
    sketches prove too many shingles of only one text go too, which leaves out none, so few of a large group's pairs are listed. The segments are so
    many that ``recall`` of the pairs right at ``similarity``, and more of those above, share one, at every size of the table.
    Texts of one fingerprint are one. Nulls, repeats and empty tables are as in ``near_duplicates``.
    """
    parts = long_segments(docs.count(), similarity, recall)
    bits = sum(w for _, w, _ in parts)
    words, p = max(WORDS, ceil(bits / BITS)), share_of_bits(similarity)
    distance = ceil(BITS * words * p + SPREAD * (BITS * words * p * (1 - p)) ** 0.5)
    prints = saved(fingerprints(docs, id_col, text_col, shingle, words))
    keyed = saved(prints.groupBy("fp").agg(F.min("key").alias("key")))

    def hashes(batches):
        import pyarrow as pa

        for batch in batches:
            sets = [distinct(shingled(t.as_py(), shingle)) for t in batch.column(1)]
            release()
            ends = np.append(0, np.cumsum([len(x) for x in sets])).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["of", "set"])

    spent = []

    def check(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        erased(docs.sparkSession, *spent)  # with the plans of the rounds before
        pairs = saved(pairs)
        asked = saved(pairs.select(F.col("p").alias("node")).union(pairs.select("q")).distinct().join(nodes.select("node", "fp"), "node").join(keyed, "fp").select("node", "key"))
        text = docs.select(text_of(text_col).alias("text")).select(F.xxhash64("text", F.octet_length("text")).alias("of"), F.col("text").cast("binary").alias("t"))
        some = maybe_among(text, F.col("of"), asked.select("key").distinct(), "__asked").where("__asked").drop("__asked")
        some = some.join(asked.select(F.col("key").alias("of")).distinct(), "of", "left_semi").groupBy("of").agg(F.first("t").alias("t"))
        sets = saved(asked.join(some.mapInArrow(hashes, "of long, set array<long>"), F.col("key") == F.col("of")).select("node", "set"))
        spent[:] = [pairs, asked, sets]
        return alike(pairs, sets, similarity)

    near = int(BITS * words * p)
    roots = linked(prints, distance, parts, words, check, ROUNDS, CENTRES, near, similarity)
    erased(docs.sparkSession, keyed, *spent)
    return grouped(prints, roots).select(F.col("id").alias("doc_id"), "component_id")
