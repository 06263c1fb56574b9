"""BPE encoding and decoding over a contiguous array of adjacent ranks.

A pre-token is held as an array of symbols and, beside it, the merge rank of every adjacent pair. The smallest
rank is found by scanning, its boundary is deleted, and the two ranks next to it are refreshed. Words above
``LONG`` symbols use a heap over the same ranks, which gives the same merges without the quadratic scan.
Vocabulary files stay where they are; their path is a parameter.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import pieces, release, row_offsets, spans, text_of, word_hashes

LONG = 256
ID = 20  # bits of a token id
MASK = (1 << ID) - 1
NONE = 1 << 62
CACHE = 50_000  # distinct chunks remembered per task; more only means that some are encoded again
PIECE = 1 << 20  # bytes of text encoded at once
MAX_FILE = 64 << 20  # a vocabulary file is broadcast only up to this size

# The code points of the Unicode property White_Space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
WIDE = WHITE[6:]  # those outside ASCII


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable Latin-1, else the next from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


# The text treatment of the tokenizer files that this encoder can read.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
MODEL_OFF = ("dropout", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")


def check_supported(spec: dict) -> None:
    """An error for a file whose texts would be encoded or decoded otherwise than here."""
    kinds = [p["type"] for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    wrong = [
        what for what, bad in (
            ("model", spec["model"].get("type") != "BPE" or any(spec["model"].get(k) for k in MODEL_OFF)), ("normalizer", (spec.get("normalizer") or {}).get("normalizers") != NORMALIZERS),
            ("pre_tokenizer", kinds != ["Split", "ByteLevel"]), ("post_processor", spec.get("post_processor") is not None), ("decoder", spec.get("decoder") is not None),
        ) if bad
    ]
    if wrong:
        raise ValueError("tokenizer file with another " + ", ".join(wrong))


class Bpe:
    """One tokenizer file: BPE whose words end in a suffix, over byte symbols, lower-cased and NFC."""

    def __init__(self, spec: bytes):
        import regex

        spec = json.loads(spec)
        model = spec["model"]
        check_supported(spec)
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        self.merge: dict[int, int] = {}  # both ids of a pair in one number -> rank and new id in one number
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merge[self.ids[a] << ID | self.ids[b]] = rank << ID | self.ids[a + b]
        self.inner = [self.ids[s] for s in byte_symbols()]
        self.last = [self.ids[s + self.suffix] for s in byte_symbols()]
        words = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(words)
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        # ids of chunks and words, as the bytes of 32-bit integers
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.of_word: dict[bytes, bytes] = {}
        pairs = sorted(self.merge)
        self.pairs, self.results = np.array(pairs, np.int64), np.array([self.merge[p] for p in pairs], np.int64)

    def word(self, raw: bytes) -> list[int]:
        """Ids of one pre-token."""
        parts = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        if len(parts) > LONG:
            return self._heap(parts)
        get = self.merge.get
        ranks = [get(a << ID | b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == NONE:
                break
            at = ranks.index(low)
            parts[at : at + 2] = [new := low & MASK]
            del ranks[at]
            if at:
                ranks[at - 1] = get(parts[at - 1] << ID | new, NONE)
            if at < len(ranks):
                ranks[at] = get(new << ID | parts[at + 1], NONE)
        return parts

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and result of merging each pair, NONE where there is no such merge (or no part, -1)."""
        key = left << ID | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.pairs[at] == key), self.results[at], NONE)

    def many(self, raw: list[bytes]) -> list[bytes]:
        """Ids of many pre-tokens; those of similar length step together, one row of parts and ranks each."""
        out: list = [b""] * len(raw)
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        inner, last = np.array(self.inner, np.int64), np.array(self.last, np.int64)
        low = 0
        for width in (4, 8, 12, 16, 24, 40) if len(self.pairs) else ():
            rows = np.flatnonzero((size > low) & (size <= width))
            low = width
            for some in np.array_split(rows, max(1, len(rows) * width >> 18)):
                if len(some):
                    self._together([raw[i] for i in some], size[some], width, inner, last, some, out)
        for i in np.flatnonzero(size > low):
            out[i] = np.array(self.word(raw[i]), np.int32).tobytes()
        return out

    def _together(self, raw, size, width, inner, last, rows, out) -> None:
        column = np.arange(width)
        text = np.frombuffer(b"".join(raw), np.uint8)
        parts = np.full((len(rows), width), -1, np.int64)
        parts[column[None, :] < size[:, None]] = inner[text]
        parts[np.arange(len(rows)), size - 1] = last[text[np.cumsum(size) - 1]]
        ranks = self.ranks(parts[:, :-1], parts[:, 1:])
        while True:
            at = ranks.argmin(axis=1)
            lowest = ranks[np.arange(len(rows)), at]
            live = lowest != NONE
            done = parts[~live]
            ids, at_byte = done.astype(np.int32).tobytes(), 4 * width * np.arange(len(done))
            for i, start, end in zip(rows[~live].tolist(), at_byte.tolist(), (at_byte + 4 * (done >= 0).sum(axis=1)).tolist()):
                out[i] = ids[start:end]
            if not live.any():
                return
            rows, parts, ranks, at = rows[live], parts[live], ranks[live], at[live]
            row, new = np.arange(len(rows)), lowest[live] & MASK
            # delete the boundary behind ``at``
            after = np.concatenate([parts[:, 1:], np.full((len(rows), 1), -1)], axis=1)
            parts = np.where(column[None, :] > at[:, None], after, parts)
            parts[row, at] = new
            after = np.concatenate([ranks[:, 1:], np.full((len(rows), 1), NONE)], axis=1)
            ranks = np.where(column[None, :-1] >= at[:, None], after, ranks)
            # refresh the ranks on both sides
            inside = at > 0
            ranks[row[inside], at[inside] - 1] = self.ranks(parts[row[inside], at[inside] - 1], new[inside])
            inside = at < width - 1
            ranks[row[inside], at[inside]] = self.ranks(new[inside], parts[row[inside], at[inside] + 1])

    def _heap(self, parts: list[int]) -> list[int]:
        n, merge = len(parts), self.merge
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        alive = [True] * n

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (found := merge.get(parts[i] << ID | parts[j])) is not None:
                heapq.heappush(heap, (found >> ID, i, parts[i], parts[j]))

        heap: list[tuple[int, int, int, int]] = []
        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else -1
            if j < 0 or parts[i] != a or parts[j] != b:
                continue
            parts[i], alive[j], after[i] = merge[a << ID | b] & MASK, False, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p, live in zip(parts, alive) if live]

    def normal(self, text: str) -> bytes:
        """The text in normal form as UTF-8, chunks apart by ASCII white space, special tokens as chunks behind a byte 255."""
        if self.marks is not None and self.marks.search(text):
            out, at = [], 0
            for mark in self.marks.finditer(text):
                out += [self._normal(text[at : mark.start()]), b"\xff" + mark[0].encode()]
                at = mark.end()
            return b" ".join([*out, self._normal(text[at:])])
        return self._normal(text)

    def _normal(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
            if any(c in text for c in WIDE):
                text = text.translate(dict.fromkeys(map(ord, WIDE), " "))
            return text.encode()
        return text.lower().encode()

    def chunks(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of runs of bytes without white space."""
        if len(self.known) >= CACHE:  # the generation before stays in reach
            self.known, self.older = {}, self.known
            self.of_word.clear()
        known, older, of_word = self.known, self.older, self.of_word
        missing, plain = {}, []
        for chunk in chunks:
            if chunk not in known:
                if (found := older.get(chunk)) is not None:
                    known[chunk] = found
                elif chunk.isalpha():  # ASCII letters only: one word
                    if chunk in of_word:
                        known[chunk] = of_word[chunk]
                    else:
                        plain.append(chunk)
                elif chunk[0] == 255:
                    known[chunk] = np.int32(self.special[chunk[1:].decode()]).tobytes()
                else:
                    missing[chunk] = [w.encode() for w in self.words.findall(chunk.decode())]
        fresh = list({w for words in missing.values() for w in words if w not in of_word}.union(plain))
        of_word.update(zip(fresh, self.many(fresh)))
        known.update((w, of_word[w]) for w in plain)
        known.update((chunk, b"".join([of_word[w] for w in words])) for chunk, words in missing.items())
        return [known[c] for c in chunks]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(self.chunks(self.normal(text).split())), np.int32).tolist()

    def strings(self, which: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes, starts and lengths by id of each token's text: 0 its number, 1 the token; each with one space behind."""
        names = [(str(i) if which == 0 else self.tokens.get(i, "")).encode() + b" " for i in range(max(self.tokens, default=-1) + 1)]
        size = np.fromiter(map(len, names), np.int64, len(names))
        return np.frombuffer(b"".join(names), np.uint8), np.cumsum(size) - size, size

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by one space, the form that a tokenizer without a decoder gives; unknown ids are skipped."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


class Chunks:
    """The chunks of some texts: each distinct one encoded once, and which of them stands where."""

    def __init__(self, bpe: Bpe, texts: list[str]):
        normal = [bpe.normal(t) for t in texts]
        raw = np.frombuffer(b"".join(normal), np.uint8)
        starts, ends, self.rows = spans(raw, np.append(0, np.cumsum([len(t) for t in normal], dtype=np.int64)))
        self.texts = len(texts)
        _, first, self.index = np.unique(word_hashes(raw, starts, ends), return_index=True, return_inverse=True) if len(starts) else (None, starts, starts)
        whole = raw.tobytes()
        found = bpe.chunks([whole[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist())])
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        own = np.frombuffer(b"".join(found), np.int32)
        self.counts = np.bincount(self.rows, weights=size[self.index], minlength=self.texts).astype(np.int64)
        self.ids = picked(own, (np.cumsum(size) - size)[self.index], size[self.index])

    def joined(self, strings: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[bytes]:
        """Each text's tokens as ``strings`` spells them, joined by one space."""
        values, start, size = strings
        size = size[self.ids]
        out = picked(values, start[self.ids], size).tobytes()
        ends = np.append(0, np.cumsum(size))[np.cumsum(self.counts)].tolist()
        return [out[s : max(s, e - 1)] for s, e in zip([0, *ends], ends)]


def picked(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """values[start : start + size] of each pair, one after the other."""
    place = np.append(0, np.cumsum(size))
    out = np.empty(int(place[-1]), values.dtype)
    for low, high in pieces(place, 1 << 20):
        n = size[low:high]
        shift = start[low:high] - place[low:high] + place[low]
        out[place[low] : place[high]] = values[np.arange(place[high] - place[low]) + np.repeat(shift, n)]
    return out


def load(path: str) -> bytes:
    if os.path.getsize(path) > MAX_FILE:
        raise ValueError(f"{path} is larger than {MAX_FILE} bytes")
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True, digests: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, and ids (array<int>) or, with ``digests``, ids_sha256 and decoded_sha256.

    Whole texts, special tokens' strings in a text become those tokens, nothing is added, cut or padded. Null text
    counts as empty: no tokens, digests of the empty text. Null ids and repeated rows stay. Other columns are not read.
    """
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(load(path))
    schema = "doc_id long, n_tokens long" + ", ids array<int>" * ids + ", ids_sha256 string, decoded_sha256 string" * digests

    def work(batches):
        bpe = Bpe(shared.value)
        spelled = [bpe.strings(i) for i in (0, 1)] if digests else []
        for batch in batches:
            for low, high in pieces(row_offsets(batch.column(1)), PIECE):
                part = batch.slice(low, high - low)
                found = Chunks(bpe, part.column(1).to_pylist())
                columns = [pa.array(found.counts)]
                if ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(found.counts)).astype(np.int32)), pa.array(found.ids)))
                columns += [pa.array([hashlib.sha256(t).hexdigest() for t in found.joined(s)]) for s in spelled]
                del found
                release()
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=[f.split(" ")[0] for f in schema.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("t")).mapInArrow(work, schema)


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): ids back to text. Null or empty ids give the empty text."""
    import pyarrow as pa

    shared = tokens.sparkSession.sparkContext.broadcast(load(path))

    def work(batches):
        bpe = Bpe(shared.value)
        for batch in batches:
            text = [bpe.decode([i for i in ids.as_py() or [] if i is not None]) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], names=["doc_id", "text"])

    return tokens.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(work, "doc_id long, text string")
