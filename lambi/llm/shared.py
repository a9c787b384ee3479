"""Small helpers that several operators use: shared storage, batches of text, hashes."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most bits of the filters that say which rows are worth a join (a power of two), and bits a key
#: below that bound.
FILTER_BITS, KEY_BITS = 1 << 27, 16
#: Bytes of text that a numpy step looks at together.
SLICE = 1 << 19

DELIMITER = np.zeros(256, dtype=bool)
DELIMITER[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_RANDOM = np.random.default_rng(20240607)
_TABLE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}
_SCRATCH: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """A new folder that the driver and all executors see: under spark.checkpoint.dir, or a
    temporary one where that is unset and Spark runs in one process (tests)."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="lambi-")
    return f"{(_SCRATCH or [top.rstrip('/')])[-1]}/lambi-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession):
    """What is cut inside goes to one folder, which is deleted at the end. Nothing that is read
    later may depend on it."""
    folder = shared_dir(spark)
    _SCRATCH.append(folder)
    try:
        yield
    finally:
        _SCRATCH.remove(folder)
        remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of any store that Spark writes to."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: ends the lineage, survives lost executors."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_slices(column: pa.Array, limit: int = SLICE, rows: int = 4096):
    """Split a string column into runs of at most `rows` rows and about `limit` bytes (or one
    row, if that is longer); null counts as empty.

    Yields (first row, last row + 1, bytes, offsets with one entry more than rows).
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), lo + rows, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every bit of a uint64 over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least n of each."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out = np.full(size, base, dtype=np.uint64)
            out[0] = 1
            _POWERS[name] = np.multiply.accumulate(out)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def range_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[begin:end] for many ranges, equal for equal bytes."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray):
    """Begin, end and row of each word ``[^\\x20\\x09-\\x0D]+``; words don't cross rows."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    gap = DELIMITER[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    word = ~gap
    first, last = word.copy(), word.copy()
    first[1:] &= gap[:-1] | edge[1:n]
    last[:-1] &= gap[1:] | edge[1:n]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begin, end, np.searchsorted(offsets, begin, side="right") - 1


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of flags between consecutive offsets."""
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


class KeyFilter:
    """Which 64-bit keys a table may hold: two bits a key, of FILTER_BITS bits at most."""

    def __init__(self, keys: DataFrame, column: str = "k"):
        size = min(FILTER_BITS, 1 << max(13, (KEY_BITS * keys.count()).bit_length()))
        mask = self.mask = size - 1
        at = [keys.select(x.bitwiseAND(mask).alias("p")) for x in (F.col(column), F.shiftrightunsigned(column, 32))]
        words = at[0].union(at[1]).groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(63).cast("int"))).alias("b"))
        got = words.toArrow()
        bits = np.zeros(size // 64, dtype=np.int64)
        bits[got["w"].to_numpy()] = got["b"].to_numpy()
        self.bits = bits.view(np.uint8)

    def has(self, keys: np.ndarray) -> np.ndarray:
        mask, keys = np.uint64(self.mask), keys.view(np.uint64)
        out = np.ones(len(keys), dtype=bool)
        for p in (keys & mask, (keys >> np.uint64(32)) & mask):
            p = p.view(np.int64)
            out &= ((self.bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1).astype(bool)
        return out
