"""Language-model scoring with a hierarchical Pitman-Yor model of word bigrams.

A word's context is the word before it (or the start of the text). Each context is a Chinese restaurant whose customers
are the words that follow; all context restaurants share one parent, whose customers are their tables, over a uniform
base of all training words and one unknown. Seating is sampled by Gibbs: in each sweep the customers of every dish are
taken away and seated anew, their number of tables drawn from its conditional given the rooms and the parent's
probabilities that the last sweep left. A pair seen once has one table in every sweep, so sweeps work on the others only. A word's probability is the average of
the predictive probabilities of the kept samples, and a text's score is the sum of the log10 probabilities of its words
and its end; after an unseen word it is the parent's.

Texts are read once, into pieces: a piece holds the hashes of its distinct words and its texts as runs of indices. Pairs of
all pieces meet in hash parts, which give each pair's count back to its pieces and name one piece that speaks for it; words meet
their totals in hash parts too. A piece asks once for each of its distinct pairs and words, so a frequent one costs one
row per piece. Draws depend on the pair alone, so all pieces draw the same. Words are 64-bit hashes; pairs are hashes of
``SPARE`` bits more than their number has, so that one in sixteen million is taken for another, at every size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import erased, mixed, pieces, release, row_offsets, saved, spans, text_buffers, word_hashes

BURN_IN = 1
SAMPLES = 2
CONCENTRATION = 1.0
PIECE = 12 << 20  # bytes of text in a piece
PART = 24 << 20  # bytes of text whose pairs meet in one part
SPARE = 24
EXACT = 64  # customers of a dish up to which its tables are drawn from the exact distribution


# ---- seating --------------------------------------------------------------------------------

def uniforms(seeds: np.ndarray, step: int) -> np.ndarray:
    """One uniform number in (0, 1) for each seed; the same seed and step always give the same number."""
    x = mixed(seeds + np.uint64(step * 0x9E3779B97F4A7C15 % (1 << 64)))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def ways(discount: float, most: int = EXACT) -> np.ndarray:
    """log of the generalised Stirling numbers: the weight of n customers at t tables is opening**t times them."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[1, 1] = 0.0
    for n in range(1, most):
        t = np.arange(1, n + 2)
        stay = n - t * discount
        with np.errstate(divide="ignore", invalid="ignore"):
            out[n + 1, 1 : n + 2] = np.logaddexp(out[n, t - 1], out[n, t] + np.where(stay > 0, np.log(np.maximum(stay, 1e-300)), -np.inf))
    return out


def poisson(mean: np.ndarray, seeds: np.ndarray, step: int) -> np.ndarray:
    """Poisson numbers, by inversion up to a mean of 30 and from the normal distribution above."""
    u = uniforms(seeds, step)
    out, term = np.zeros(len(mean), np.int64), np.exp(-np.minimum(mean, 30.0))
    total = term.copy()
    for k in range(1, 90):
        more = u > total
        if not more.any():
            break
        out += more
        term = term * np.minimum(mean, 30.0) / k
        total = np.where(more, total + term, total)
    normal = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * uniforms(seeds, step + 1))
    return np.where(mean > 30, np.maximum(0, np.rint(mean + np.sqrt(mean) * normal)).astype(np.int64), out)


def seat(customers: np.ndarray, opening: np.ndarray, discount: float, seeds: np.ndarray, sweep: int) -> np.ndarray:
    """Tables of each dish when its customers are seated anew, given the weight ``opening`` of a new table.

    The number t has probability in proportion to opening**t times the ways of seating n at t tables. Up to ``EXACT``
    customers that is drawn as it stands; above, the tables besides the largest are a Poisson number whose mean solves
    n = w y**(d-1) (1-y), w (1 - y**d) / d, which the distribution approaches as n grows.
    """
    tables = (customers > 0).astype(np.int64)
    log, step = ways(discount), sweep * 1_000_003
    u = uniforms(seeds, step)
    small = np.flatnonzero((customers > 1) & (customers <= EXACT))
    order = small[np.argsort(customers[small], kind="stable")]
    edges = np.searchsorted(customers[order], np.arange(2, EXACT + 2))
    for n, low, high in zip(range(2, EXACT + 1), edges[:-1], edges[1:]):
        for start in range(low, high, 1 << 18):
            at = order[start : min(high, start + (1 << 18))]
            weight = np.arange(1, n + 1)[None, :] * np.log(opening[at])[:, None] + log[n, 1 : n + 1][None, :]
            share = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            tables[at] = 1 + (share < u[at, None] * share[:, -1:]).sum(axis=1)
    large = np.flatnonzero(customers > EXACT)
    if len(large):
        n, w = customers[large].astype(np.float64), opening[large]
        low, high = np.zeros(len(large)), np.ones(len(large))
        for _ in range(60):
            y = (low + high) / 2
            with np.errstate(divide="ignore", over="ignore"):
                over = w * y ** (discount - 1) * (1 - y) > n
            low, high = np.where(over, y, low), np.where(over, high, y)
        mean = w * (1 - high**discount) / discount
        tables[large] = np.minimum(1 + poisson(mean, seeds[large], step + 1), customers[large])
    return tables


def discount_of(ones: float, twos: float) -> float:
    """The usual estimate n1 / (n1 + 2 n2), kept inside (0, 1)."""
    return float(np.clip(ones / max(1.0, ones + 2 * twos), 0.05, 0.95))


def predictive(n, tables, room_customers, room_tables, base, discount: float):
    """Probability of dishes with n customers at their tables in restaurants of so many customers and tables, over a base."""
    room = CONCENTRATION + room_customers
    return np.maximum(n - discount * tables, 0) / room + (CONCENTRATION + discount * room_tables) / room * base


# ---- pieces of text -------------------------------------------------------------------------

def lowered(raw: np.ndarray) -> np.ndarray:
    return np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)


def tokens_of(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct lower-cased words of some texts, all tokens as indices (one more than the words: the end), and tokens per text."""
    raw, offsets = text_buffers(column)
    raw, parts = lowered(raw), []
    for low, high in pieces(offsets):
        base = offsets[low]
        own, local = raw[base : offsets[high]], offsets[low : high + 1] - base
        starts, ends, rows = spans(own, local)
        parts.append((rows + low, word_hashes(own, starts, ends) if len(starts) else np.zeros(0, np.uint64)))
    rows, hashes = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.uint64) for i in range(2))
    words, index = np.unique(hashes, return_inverse=True)
    sizes = np.bincount(rows.astype(np.int64), minlength=len(offsets) - 1) + 1
    stream = np.full(int(sizes.sum()), len(words), np.int32)
    stream[np.arange(len(index)) + rows.astype(np.int64)] = index  # each text before has one end
    return words, stream, sizes


def packed(x: np.ndarray) -> bytes:
    """An array as compressed planes of its bytes, behind its length."""
    import pyarrow as pa

    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T)
    return len(x).to_bytes(8, "little") + (pa.compress(planes.data if x.size else b"", codec="zstd", asbytes=True))


def unpacked(data: bytes, kind) -> np.ndarray:
    import pyarrow as pa

    size, n = np.dtype(kind).itemsize, int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], n * size, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


class Piece:
    """Words, tokens and distinct pairs of one row of the table of pieces. The last word is the end, and the start's context."""

    def __init__(self, row: dict):
        self.name = row["piece"]
        self.words = np.append(unpacked(row["words"], np.uint64), np.uint64(0))
        self.tokens = unpacked(row["tokens"], np.int32).astype(np.int64)
        self.sizes = unpacked(row["sizes"], np.int32).astype(np.int64)
        self.held = unpacked(row["held"], np.uint8).astype(bool)

    def pairs(self, inverse: bool = False):
        """Distinct pairs in the order of their hashes: context, word, hash, and with ``inverse`` the pair of each token."""
        wide, before = len(self.words), np.append(len(self.words) - 1, self.tokens[:-1])
        code, of = before * wide + self.tokens, None
        if inverse:
            code, of = np.unique(code, return_inverse=True)
        else:  # sorting is several times faster than a table of hashes here
            code = np.sort(code)
            code = code[np.append(True, code[1:] != code[:-1])]
        context, word = code // wide, code % wide
        keys = mixed(mixed(self.words[context] + np.uint64(0x9E3779B97F4A7C15)) ^ (self.words[word] * np.uint64(0xD6E8FEB86659FD93)))
        order = np.argsort(keys)
        if inverse:
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            of = place[of]
        return context[order], word[order], keys[order], of

    def learned(self) -> np.ndarray:
        """Which tokens are of training texts."""
        return np.repeat(~self.held, self.sizes)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Parts 0 .. ``parts`` - 1 of sorted hashes, ascending."""
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def part_column(word: Column, parts: int) -> Column:
    return F.shiftright(F.shiftrightunsigned(word, 32) * F.lit(parts), 32).cast("int")


def cut(hashes: np.ndarray, parts: int):
    """(part, low, high) of the runs of sorted hashes in each part."""
    edges = np.searchsorted(part_of(hashes, parts), np.arange(parts + 1))
    return [(p, low, high) for p, (low, high) in enumerate(zip(edges[:-1], edges[1:])) if high > low]


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: int = 1, folds: int = 5, samples: int = SAMPLES, burn_in: int = BURN_IN) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows whose crc32(id as text) mod ``folds`` is not ``fold``. Tokens are the words, A-Z lower-cased, and
    one end per text; null text is empty and has the end only. ``base_score`` is the add-a-half unigram log10 probability,
    ``score`` that of the hierarchical Pitman-Yor model, in which every word outside the training text is the one unknown.
    Null ids count as the empty text in the fold; repeated rows count each. Without training text nothing is known and
    every token has probability one. An empty table gives no rows. Other columns are not read.
    """
    import pyarrow as pa

    held = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == fold
    source = docs.select(F.col(id_col).cast("long").alias("id"), held.alias("held"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def take(batches):
        from pyspark import TaskContext

        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            text = batch.column(2)
            for low, high in pieces(row_offsets(text), PIECE):
                release()
                words, stream, sizes = tokens_of(text.slice(low, high - low))
                row = {
                    "piece": (task << 32) + n, "ids": batch.column(0).slice(low, high - low).to_pylist(), "held": packed(batch.column(1).slice(low, high - low).to_numpy(zero_copy_only=False).astype(np.uint8)),
                    "sizes": packed(sizes.astype(np.int32)), "words": packed(words), "tokens": packed(stream), "bytes": int(len(stream)) * 6,
                }
                n += 1
                yield pa.RecordBatch.from_pylist([row], schema=shape)

    shape = pa.schema([("piece", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.binary()), ("sizes", pa.binary()), ("words", pa.binary()), ("tokens", pa.binary()), ("bytes", pa.int64())])
    table = saved(source.mapInArrow(take, "piece long, ids array<long>, held binary, sizes binary, words binary, tokens binary, bytes long"), compression="zstd")
    texts = ["piece", "held", "sizes", "words", "tokens"]
    size = table.agg(F.sum("bytes")).first()[0] or 0
    parts, spare = int(size // PART) + 1, np.uint64(max(0, 64 - SPARE - int(size).bit_length()))

    # ---- counts of pairs, given back to the pieces that hold them

    def pairs_out(batches):
        for batch in batches:
            for row in batch.to_pylist():
                release()
                p = Piece(row)
                _, _, keys, of = p.pairs(inverse=True)
                n = np.bincount(of, weights=p.learned(), minlength=len(keys)).astype(np.int64)
                for part, low, high in cut(keys, parts):
                    yield pa.RecordBatch.from_pylist([{"part": part, "piece": p.name, "keys": packed(keys[low:high] >> spare), "n": packed(n[low:high])}], schema=asked_shape)

    asked_shape = pa.schema([("part", pa.int32()), ("piece", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())])

    def counted(group):
        release()
        group = group.sort_by("piece")
        keys = [unpacked(k.as_py(), np.uint64) for k in group["keys"]]
        n = np.concatenate([unpacked(k.as_py(), np.int64) for k in group["n"]])
        every = np.concatenate(keys)
        _, of = np.unique(every, return_inverse=True)
        total = np.bincount(of, weights=n).astype(np.int64)
        speaker = np.zeros(len(total), np.int64)
        held_by = np.flatnonzero(n > 0)
        speaker[of[held_by[::-1]]] = held_by[::-1]  # the first place that learned the pair
        mine = 2 * total[of] + (speaker[of] == np.arange(len(of)))
        ends = np.cumsum([len(k) for k in keys])
        return pa.table({"piece": group["piece"], "part": group["part"], "n": pa.array([packed(mine[e - len(k) : e]) for k, e in zip(keys, ends)], pa.binary())})

    asked = table.select(*texts).mapInArrow(pairs_out, "part int, piece long, keys binary, n binary")
    counts = saved(asked.groupBy("part").applyInArrow(counted, "piece long, part int, n binary"), compression="zstd")
    erased(table.sparkSession)

    def counts_of(rows) -> tuple[np.ndarray, np.ndarray]:
        """Counts of a piece's pairs in the order of their hashes, and whether the piece speaks for the pair."""
        rows = sorted((r for r in rows.to_pylist() if r["n"] is not None), key=lambda r: r["part"])
        code = np.concatenate([unpacked(r["n"], np.int64) for r in rows]) if rows else np.zeros(0, np.int64)
        return code >> 1, (code & 1).astype(bool)

    def runs_of(words: np.ndarray, **columns) -> list[dict]:
        """Sorted words with some figure that is not zero, and their figures, a row for each part."""
        some = np.flatnonzero(np.any(list(columns.values()), axis=0))
        return [{"part": part, "words": packed(words[some][low:high]), **{k: packed(v[some][low:high].astype(np.int64)) for k, v in columns.items()}} for part, low, high in cut(words[some], parts)]

    def summed(group, columns: tuple[str, ...]):
        """The runs of a part as one row per word, figures added."""
        words, of = np.unique(np.concatenate([unpacked(w.as_py(), np.uint64) for w in group["words"]]), return_inverse=True)
        total = lambda c: np.bincount(of, weights=np.concatenate([unpacked(x.as_py(), np.int64) for x in group[c]]), minlength=len(words)).astype(np.int64)
        return pa.table({"word": pa.array(words.view(np.int64)), **{c: pa.array(total(c)) for c in columns}})

    def spoken(left, right):
        """Of each word of a piece: its tokens, and of the pairs that the piece speaks for those that it begins (all, seen once, twice) and ends.

        A further row holds the piece's pairs that are seen again: their words, and context, word, hash and count of each.
        """
        release()
        p = Piece(left.to_pylist()[0])
        context, word, keys, _ = p.pairs()
        (n, speaks), wide = counts_of(right), len(p.words)
        n = np.where(speaks, n, 0)
        tally = lambda of, mask: np.bincount(of[mask], minlength=wide)
        tokens = np.bincount(p.tokens, weights=p.learned(), minlength=wide)
        rising = np.append(wide - 1, np.arange(wide - 1))  # the end first
        found = {"n": tokens, "t": tally(context, n > 0), "ones": tally(context, n == 1), "twos": tally(context, n == 2), "c": tally(word, n > 0)}
        rows = runs_of(p.words[rising], **{k: v[rising] for k, v in found.items()})
        again = np.flatnonzero(n > 1)
        used, of = np.unique(np.concatenate([p.words[context[again]], p.words[word[again]]]), return_inverse=True)
        of = of.astype(np.int32)
        many = {"piece": p.name, "words": packed(used), "context": packed(of[: len(again)]), "follows": packed(of[len(again) :]), "keys": packed(keys[again]), "count": packed(n[again])}
        return pa.Table.from_pylist([*rows, {"many": many}], schema=spoken_shape)

    figures = ("n", "t", "ones", "twos", "c")
    many_shape = pa.struct([("piece", pa.int64()), *[(c, pa.binary()) for c in ("words", "context", "follows", "keys", "count")]])
    spoken_shape = pa.schema([("part", pa.int32()), ("words", pa.binary()), *[(c, pa.binary()) for c in figures], ("many", many_shape)])

    def by_piece(right: DataFrame, f, kind: str, columns: list[str] = texts) -> DataFrame:
        return table.select(*columns).groupBy("piece").cogroup(right.groupBy("piece")).applyInArrow(f, kind)

    told_by = saved(by_piece(counts, spoken, "part int, words binary, n binary, t binary, ones binary, twos binary, c binary, many struct<piece:long,words:binary,context:binary,follows:binary,keys:binary,count:binary>"), compression="zstd")
    erased(table.sparkSession)
    add = lambda group: summed(group, figures)
    state = saved(told_by.where("many is null").drop("many").groupBy("part").applyInArrow(add, "word long, n long, t long, ones long, twos long, c long").where("n > 0"))
    many = told_by.where("many is not null").select("many.*")
    erased(table.sparkSession)
    none = F.coalesce(F.sum("n"), F.lit(0))
    how_many = lambda v: F.coalesce(F.sum((F.col("c") == v).cast("long")), F.lit(0))
    whole = state.agg(none.alias("n"), F.count("*").alias("types"), *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in ("ones", "twos")], how_many(1).alias("c1"), how_many(2).alias("c2")).first()
    total, types = whole["n"], whole["types"]
    own, above = discount_of(whole["ones"], whole["twos"]), discount_of(whole["c1"], whole["c2"])

    # ---- sweeps: ts and ps hold each word's tables as a context and its probability in the parent after every sweep

    def with_parent(batches):
        for batch in batches:
            c, word = (batch.column(batch.schema.get_field_index(x)).to_numpy() for x in ("c", "word"))
            up = seat(c, np.full(len(c), share), above, mixed(word.view(np.uint64).copy()), sweep)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(up)], names=[*batch.schema.names, "up"])

    ts, ps = F.array().cast("array<double>"), F.array().cast("array<double>")
    state = state.select("word", "n", "t", "c", "c", F.lit(1).cast("long").alias("up"), ts.alias("ts"), ps.alias("ps")).toDF("word", "n", "t0", "c0", "c", "up", "ts", "ps").withColumn("t", F.col("t0"))
    unknown = []

    def settled(rows: DataFrame) -> DataFrame:
        """The state with this sweep's tables and probabilities appended, written."""
        nonlocal share
        customers, tables = (float(x or 0) for x in rows.agg(F.sum("c"), F.sum("up")).first())
        rest = (CONCENTRATION + above * tables) / (CONCENTRATION + customers) / (types + 1)
        unknown.append(rest)
        share = max((CONCENTRATION + above * tables) / (types + 1), 1e-12)
        p = F.greatest(F.col("c") - above * F.col("up"), F.lit(0.0)) / (CONCENTRATION + customers) + rest
        return saved(rows.select("word", "n", "t0", "c0", F.concat("ts", F.array(F.col("t").cast("double"))).alias("ts"), F.concat("ps", F.array(p)).alias("ps")))

    def words_out(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words = unpacked(row["words"], np.uint64)
                if not len(words) or words[0]:
                    words = np.append(np.uint64(0), words)  # the end comes first, as its hash is zero
                for part, low, high in cut(words, parts):
                    yield pa.RecordBatch.from_pylist([{"part": part, "piece": row["piece"], "words": packed(words[low:high])}], schema=words_shape)

    words_shape = pa.schema([("part", pa.int32()), ("piece", pa.int64()), ("words", pa.binary())])

    def looked_up(asks, known):
        """What the state knows of the asked words, a row for each piece: counts and the kept columns, zero for unknown words."""
        if not asks.num_rows:
            return pa.table({"piece": pa.array([], pa.int64()), "part": pa.array([], pa.int32()), "f": pa.array([], pa.binary()), "g": pa.array([], pa.binary())})
        release()
        word = known["word"].to_numpy().view(np.uint64) if known.num_rows else np.zeros(0, np.uint64)
        order = np.argsort(word)
        word, wide = word[order], 1 + 2 * depth
        facts = np.zeros((len(word) + 1, wide))
        if len(word):
            facts[:-1, 0] = known["n"].to_numpy()[order]
            for i, name in enumerate(("ts", "ps")):
                lists = known[name].combine_chunks()
                facts[:-1, 1 + i * depth : 1 + (i + 1) * depth] = lists.flatten().to_numpy().reshape(len(word), -1)[order][:, -depth:]
        out = []
        for row in asks["words"]:
            hashes = unpacked(row.as_py(), np.uint64)
            at = np.minimum(np.searchsorted(word, hashes), max(0, len(word) - 1))
            at = np.where(word[at] == hashes, at, len(word)) if len(word) else np.zeros(len(hashes), np.int64)
            out.append((packed(facts[at, 0].copy()), packed(facts[at, 1:].astype(np.float32).ravel())))
        f, g = zip(*out)
        return pa.table({"piece": asks["piece"], "part": asks["part"], "f": pa.array(f, pa.binary()), "g": pa.array(g, pa.binary())})

    def facts_of(rows) -> np.ndarray:
        """Facts of the asked words in the order of their hashes, the end first."""
        rows = sorted((r for r in rows.to_pylist() if r["f"] is not None), key=lambda r: r["part"])
        found = [np.column_stack([unpacked(r["f"], np.float64), unpacked(r["g"], np.float32).reshape(-1, 2 * depth).astype(np.float64)]) for r in rows]
        return np.concatenate(found) if found else np.zeros((1, 1 + 2 * depth))

    def facts(asking: DataFrame) -> DataFrame:
        """Facts of the words of every row of (piece, words)."""
        asks = asking.select("piece", "words").mapInArrow(words_out, "part int, piece long, words binary")
        known = state.select(part_column(F.col("word"), parts).alias("part"), "word", "n", "ts", "ps")
        return asks.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(looked_up, "piece long, part int, f binary, g binary")

    def seated(left, right):
        """Tables beyond the first of the pairs that a piece speaks for, by context and by word."""
        if not left.num_rows:
            return seated_shape.empty_table()
        release()
        row, known = left.to_pylist()[0], facts_of(right)
        words, context, word = unpacked(row["words"], np.uint64), unpacked(row["context"], np.int32), unpacked(row["follows"], np.int32)
        known = known[len(known) - len(words) :]  # without the end where no pair has it
        opening = (CONCENTRATION + own * known[context, 1]) * known[word, 2]
        more = seat(unpacked(row["count"], np.int64), np.maximum(opening, 1e-300), own, unpacked(row["keys"], np.uint64), sweep) - 1
        tally = lambda of: np.bincount(of, weights=more, minlength=len(words))
        return pa.Table.from_pylist(runs_of(words, t=tally(context), c=tally(word)), schema=seated_shape)

    seated_shape = pa.schema([("part", pa.int32()), *[(c, pa.binary()) for c in ("words", "t", "c")]])

    share, sweep, depth = 1.0, 0, 1
    state = settled(state)
    for sweep in range(1, burn_in + samples):
        more = many.groupBy("piece").cogroup(facts(many).groupBy("piece")).applyInArrow(seated, "part int, words binary, t binary, c binary")
        more = more.groupBy("part").applyInArrow(lambda group: summed(group, ("t", "c")), "word long, t long, c long").toDF("of", "mt", "mc")
        new = state.join(more, F.col("word") == F.col("of"), "left")
        new = new.select("word", "n", "t0", "c0", (F.col("c0") + F.coalesce("mc", F.lit(0))).alias("c"), "ts", "ps", (F.col("t0") + F.coalesce("mt", F.lit(0))).alias("t"))
        kind = "word long, n long, t0 long, c0 long, c long, ts array<double>, ps array<double>, t long, up long"
        seats = saved(new.mapInArrow(with_parent, kind))
        old, state = state, settled(seats)
        erased(table.sparkSession, old, seats)

    kept = range(burn_in, burn_in + samples)
    depth = burn_in + samples
    result = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def add_up(left, right):
        if not left.num_rows:
            return result.empty_table()
        release()
        row = left.to_pylist()[0]
        p = Piece(row)
        context, word, keys, of = p.pairs(inverse=True)
        (n, _), known = counts_of(right), facts_of(right)
        known = np.append(known[1:], known[:1], axis=0)  # the end last
        count, t, base = known[:, 0], known[:, 1 : 1 + depth], known[:, 1 + depth :]
        base = np.where(count[:, None] > 0, base, np.array(unknown)[None, :])
        again, probability = np.flatnonzero(n > 1), np.zeros(len(n))
        for s in kept:
            tables = np.minimum(n, 1)
            if s:
                opening = (CONCENTRATION + own * t[context[again], s - 1]) * base[word[again], s - 1]
                tables[again] = seat(n[again], np.maximum(opening, 1e-300), own, keys[again], s)
            probability += predictive(n, tables, count[context], t[context, s], base[word, s], own) / len(kept)
        rows = np.repeat(np.arange(len(p.sizes)), p.sizes)
        add = lambda x: np.bincount(rows, weights=x, minlength=len(p.sizes))
        plain = np.log10((count + 0.5) / (total + 0.5 * (types + 1)))
        return pa.table({
            "doc_id": pa.array(row["ids"], pa.int64()), "held_out": pa.array(p.held), "n_tokens": pa.array(p.sizes), "n_known": pa.array(add((count > 0)[p.tokens]).round().astype(np.int64)),
            "base_score": pa.array(add(plain[p.tokens])), "score": pa.array(np.minimum(add(np.log10(probability)[of]), 0)),
        }, schema=result)

    erased(table.sparkSession, told_by)
    told = counts.withColumns({c: F.lit(None).cast("binary") for c in "fg"}).unionByName(facts(table).withColumn("n", F.lit(None).cast("binary")))
    scored = by_piece(told, add_up, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double", [*texts, "ids"])
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
