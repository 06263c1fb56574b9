"""Helpers that several corpus operators use: durable intermediates, buckets, components, word spans.

Words everywhere are maximal runs of bytes other than space and the control bytes 9 to 13.
"""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_GAP = r"[\x20\x09-\x0D]+"


# ---- durable intermediates ------------------------------------------------------------------

def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``); a temporary one where it is unset and the master is local."""
    context = spark.sparkContext
    named = context.getCheckpointDir()
    if named is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = folder or tempfile.mkdtemp(prefix="musterline-")
        context.setCheckpointDir(folder)
        named = context.getCheckpointDir()
    return named


def saved(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again: short lineage, safe from lost executors.

    The files go when the application ends, or with ``erased``.
    """
    spark = df.sparkSession
    target = f"{shared_dir(spark)}/saved-{uuid.uuid4().hex}"
    df.write.parquet(target, compression=compression)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(target)


def erased(spark: SparkSession, *frames: DataFrame) -> None:
    """Deletes the files of frames that were ``saved`` and are not needed any more, and has Spark drop the shuffle files that nothing refers to."""
    context = spark.sparkContext
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()  # the driver's references to finished plans
    context._jvm.System.gc()


def maybe_among(df: DataFrame, key: Column, keys: DataFrame, name: str, bits: int = 1 << 24) -> DataFrame:
    """``df`` with boolean ``name``: true wherever the long ``key`` is in the one column of ``keys``, and for few others.

    The keys set bits of a map of at most ``bits`` bits, which is broadcast: two megabytes however many keys there are.
    Null keys are not among any.
    """
    spot = lambda k: F.pmod(k, F.lit(bits))
    place = spot(F.col(keys.columns[0]))
    maps = keys.select(F.bitmap_bucket_number(place).alias("__of"), F.bitmap_bit_position(place).alias("__bit")).groupBy("__of").agg(F.bitmap_construct_agg("__bit").alias("__map"))
    found = df.withColumn("__spot", spot(key)).join(F.broadcast(maps), F.bitmap_bucket_number("__spot") == F.col("__of"), "left")
    bit = F.bitmap_bit_position("__spot").cast("int")
    byte = F.conv(F.hex(F.col("__map").substr((F.shiftright(bit, 3) + 1), F.lit(1))), 16, 10).cast("int")
    one = F.call_function("shiftright", byte, bit.bitwiseAND(F.lit(7))).bitwiseAND(F.lit(1)) == 1
    return found.withColumn(name, F.coalesce(one, F.lit(False))).drop("__spot", "__of", "__map")


def text_of(column: str | Column) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def bucketed(docs: DataFrame, id_col: str, text_col: str, bucket_mb: float = 8.0, name: str = "bucket") -> DataFrame:
    """Adds a hash bucket of the id so that a bucket holds about ``bucket_mb`` of text.

    The number of buckets follows the total number of bytes, so one bucket stays a bounded piece of work.
    """
    total = docs.select(F.sum(F.octet_length(F.col(text_col))).alias("b")).first()["b"] or 0
    buckets = max(1, int(total / (bucket_mb * 1e6)) + 1)
    return docs.withColumn(name, F.pmod(F.xxhash64(F.col(id_col)), F.lit(buckets)).cast("int"))


# ---- connected components -------------------------------------------------------------------

def digest(pairs: DataFrame) -> tuple:
    """Number and order-free hash of the rows; a round that changes no edge leaves it as it was."""
    code = F.xxhash64("u", "v")
    return tuple(pairs.agg(F.count("*"), F.bit_xor(code), F.sum(F.shiftright(code, 20))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for every node of an edge, the smallest node reachable from it.

    Alternating large-star and small-star rounds; both regroup edges around minima, so a node of any degree
    only passes through ``min`` aggregates and joins that can be split, never through a collected list.
    Each round is checkpointed. Self loops and null ends are ignored.
    """
    shared_dir(edges.sparkSession)
    pairs = (
        edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct().checkpoint()
    )
    after = digest(pairs)
    while True:
        # large star: every neighbour that is larger than the centre is linked to the centre's minimum
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: neighbours that are not larger, and the centre itself, are linked to the minimum
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (
            joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
            .where(F.col("u") != F.col("v")).distinct().checkpoint()
        )
        before, after, pairs = after, digest(small), small
        if before == after:
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


# ---- word spans over Arrow text -------------------------------------------------------------

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
ODD = 0x9E3779B97F4A7C15  # an odd multiplier, so powers have inverses modulo 2**64
INVERSE = pow(ODD, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads every bit (in place on a fresh array)."""
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(33)
    return x


def rolled(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each pair, equal for equal runs wherever they stand."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(ODD, n), out=sums[1:])
    out = (sums[ends] - sums[starts]) * powers(INVERSE, n + 1)[starts]
    out += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mixed(out)


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string or binary column (or chunked column); null counts as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def row_offsets(column) -> np.ndarray:
    """Byte offsets of the rows of an Arrow string column, without copying its text."""
    import pyarrow.compute as pc

    return np.append(0, np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)))


def pieces(offsets: np.ndarray, size: int = 1 << 20):
    """Row ranges (low, high) of about ``size`` bytes each; a longer row stands alone."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + size, side="right")) - 1)
        yield low, high
        low = high


def spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; a word never crosses rows."""
    n = len(raw)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    word = ~SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | edge[1:-1]
    end = word.copy()
    end[:-1] &= ~word[1:] | edge[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word (none is empty): its blocks of eight bytes, each mixed with its place in the word, added up and mixed again.

    Blocks are mixed before they are added, so no pattern of letters cancels out as it would in a polynomial of the bytes.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    blocks = (size + 7) >> 3
    first = np.cumsum(blocks) - blocks
    place = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    at = np.repeat(starts, blocks) + 8 * place
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(raw) + 1,), "<u8", padded, 0, (1,))  # the eight bytes from each place on
    part = eight[at].astype(np.uint64)
    short = np.minimum(np.repeat(ends, blocks) - at, 8)
    part &= np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - short) * 8).astype(np.uint64)
    total = np.add.reduceat(mixed(part + (place + 1).astype(np.uint64) * np.uint64(ODD)), first)
    return mixed(total + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gathered(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """An Arrow binary array of raw[start:end]."""
    import pyarrow as pa

    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    index = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw[index].tobytes())])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def release() -> None:
    """Give memory that a finished piece of work has freed back to the system; a worker outlives its tasks."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
