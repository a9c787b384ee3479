"""Benchmark passages inside documents by a prefix-filtered set join (operator 12)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lambi.llm.shared import LOWER, KeyFilter, cut, mix, range_hashes, signed, text_slices

#: Words of a shingle; a window is the set of its shingles.
SHINGLE = 5
_GAP = np.zeros(256, dtype=bool)
_GAP[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _words(data: np.ndarray, offsets: np.ndarray):
    """Lower-cased bytes; begin, end and row of each word ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    low = LOWER[data]
    word = ~_GAP[low]
    edge = np.zeros(len(low) + 1, dtype=bool)
    edge[offsets] = True
    before, behind = np.ones(len(low), dtype=bool), np.ones(len(low), dtype=bool)
    before[1:], behind[:-1] = ~word[:-1] | edge[1:-1], ~word[1:] | edge[1:-1]
    begin, end = np.flatnonzero(word & before), np.flatnonzero(word & behind) + 1
    return low, begin, end, np.searchsorted(offsets, begin, side="right") - 1


def _shingles(hashes: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and 64-bit key of each run of k words inside a row."""
    m = max(0, len(hashes) - k + 1)
    rolled = np.zeros(m, dtype=np.uint64)
    for i in range(k):
        rolled = rolled * _STEP + hashes[i : i + m]
    at = np.flatnonzero(row[:m] == row[k - 1 :]) if m else np.zeros(0, np.int64)
    return at, signed(mix(rolled[at] + np.uint64(k)))


def _windows(benchmark: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """(item, k, window, place, key, size) of every shingle of every window: k words, joined by blanks;
    the shingle's place among them, its key and its words."""
    source = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("body")).where("item is not null")

    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(1)):
                low, begin, end, row = _words(data, offsets)
                hashes, raw = range_hashes(low, begin, end), low.tobytes()
                starts = np.searchsorted(row, np.arange(hi - lo + 1))
                for i, item in enumerate(batch.column(0)[lo:hi].to_pylist()):
                    a, n = starts[i], starts[i + 1] - starts[i]
                    k = min(window, n)
                    if not n:
                        continue
                    size = min(shingle, k)
                    said = [raw[begin[j] : end[j]].decode() for j in range(a, a + n)]
                    keys = _shingles(hashes[a : a + n], row[a : a + n], size)[1]
                    rows = [(" ".join(said[s : s + k]), place, keys[s + place]) for s in range(n - k + 1) for place in range(k - size + 1)]
                    text, place, key = zip(*rows)
                    same = lambda v: pa.array([v] * len(text), pa.int32())  # noqa: B023, E731
                    columns = {"item": [item] * len(rows), "k": same(k), "window": text, "place": pa.array(place, pa.int32()), "key": pa.array(key, pa.int64()), "size": same(size)}
                    yield pa.RecordBatch.from_pydict(columns)

    return source.mapInArrow(run, "item string, k int, window string, place int, key long, size int")


def _sizes(windows: DataFrame) -> list[int]:
    """Lengths of shingles that occur: at most `SHINGLE` values."""
    return sorted(r[0] for r in windows.select("size").distinct().collect())


def _counts(docs: DataFrame, text_col: str, wanted, sizes: list[int]) -> DataFrame:
    """How often each key that passes the filter occurs in all texts; summed by slice first."""

    def run(batches):
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                low, begin, end, row = _words(data, offsets)
                hashes, held = range_hashes(low, begin, end), wanted.value
                for size in sizes:
                    keys = _shingles(hashes, row, size)[1]
                    key, n = np.unique(keys[held.has(keys)], return_counts=True)
                    if len(key):
                        yield pa.RecordBatch.from_pydict({"key": key, "n": n.astype(np.int64)})

    return docs.select(F.col(text_col).cast("string").alias("body")).mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


HIT = pa.struct([("at", pa.int32()), ("key", pa.int64()), ("first", pa.int32()), ("around", pa.string())])


def _hits(docs: DataFrame, id_col: str, text_col: str, wanted, sizes: list[int], window: int) -> DataFrame:
    """(id, h1, h2, n_words, hits) of each row: where a shingle of the filter occurs, with the words
    around it that a window there can have. h1 and h2 name the text (128 bits of hash)."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(body).alias("h1"), F.xxhash64(F.lit(1), body).alias("h2"), body.alias("body"))
    schema = StructType([*source.schema.fields[:3], *StructType.fromDDL("n_words long, hits array<struct<at:int,key:long,first:int,around:string>>").fields])

    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(3)):
                low, begin, end, row = _words(data, offsets)
                hashes, held = range_hashes(low, begin, end), wanted.value
                starts = np.searchsorted(row, np.arange(hi - lo + 1))
                found = [[], []]
                for size in sizes:
                    at, keys = _shingles(hashes, row, size)
                    of = held.has(keys)
                    found[0].append(at[of])
                    found[1].append(keys[of])
                at, keys = np.concatenate(found[0] or [np.zeros(0, np.int64)]), np.concatenate(found[1] or [np.zeros(0, np.int64)])
                order = np.argsort(at, kind="stable")
                at, keys = at[order], keys[order]
                of, raw = row[at], low.tobytes()
                left = np.maximum(at - window + 1, starts[of])
                right = np.minimum(at + window, starts[of + 1])
                around = [" ".join(raw[begin[j] : end[j]].decode() for j in range(a, b)) for a, b in zip(left, right)]
                hit = pa.StructArray.from_arrays([pa.array((at - starts[of]).astype(np.int32)), pa.array(keys, pa.int64()), pa.array((left - starts[of]).astype(np.int32)), pa.array(around, pa.string())], fields=list(HIT))
                ends = np.searchsorted(of, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*(batch.column(i)[lo:hi] for i in range(3)), pa.array(np.diff(starts).astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends), hit)], names=schema.names)

    return source.mapInArrow(run, schema)


def _covered(places: DataFrame) -> DataFrame:
    """Words of each text in any of its windows (id, h1, h2, start, k): each adds what lies behind the
    furthest end before it."""
    text = Window.partitionBy("id", "h1", "h2")
    stop = F.col("start") + F.col("k")
    before = F.coalesce(F.max(stop).over(text.orderBy("start", "k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return places.withColumn("new", F.greatest(F.lit(0), stop - F.greatest("start", before)))


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = 10, shingle: int = SHINGLE) -> DataFrame:
    """Words of each document that lie in a passage of the benchmark, and the items it holds.

    A window is `window` consecutive words of an item, or all words of a shorter one. Windows and
    documents are sets of shingles of `shingle` words. A window that is held whole has all its
    shingles there, so one suffices as its prefix: the rarest over all documents (ties: the least
    key), found by a count of every document. Documents are joined with windows by that shingle
    alone; a place is kept if the window's length fits between both ends of the text around the
    shingle's place (length and position), and if the words there are the window's.

    Per row of `docs`: the id, n_words, n_hit, n_items, items_sha256 (sha256 of the ids, sorted as
    strings, joined by commas), contaminated. Null and empty texts have no words, items without words
    no window, and a null item id is no item. Null ids, repeated rows and ids count each for itself.
    Texts of any length are searched whole. Repeated items of one id are one. Only the named columns
    are read, so others can't clash. An empty table gives an empty result, an empty benchmark no hit.
    """
    spark = docs.sparkSession
    windows = cut(_windows(benchmark, item_col, item_text, window, shingle))
    sizes = _sizes(windows)
    keys = spark.sparkContext.broadcast(KeyFilter(windows.select(F.col("key").alias("k")).distinct()))  # of 16 MB at most
    seen = _counts(docs, text_col, keys, sizes)
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "place")).alias("p")
    # windows of no occurrence at all are left out: a shingle of theirs is nowhere
    prefixes = cut(windows.join(seen, "key", "left").groupBy("item", "k", "window").agg(rarest).where("p.n > 0").select("item", "k", "window", "p.key", "p.place"))
    keys = spark.sparkContext.broadcast(KeyFilter(prefixes.select(F.col("key").alias("k")).distinct()))
    found = cut(_hits(docs, id_col, text_col, keys, sizes, window))
    each = found.select("id", "h1", "h2", "n_words", F.explode("hits").alias("hit")).select("id", "h1", "h2", "n_words", "hit.*")
    start, skip = F.col("at") - F.col("place"), F.col("at") - F.col("place") - F.col("first")
    met = each.join(prefixes, "key").where((start >= 0) & (start + F.col("k") <= F.col("n_words")))
    same = F.array_join(F.slice(F.split("around", " "), skip + 1, F.col("k")), " ") == F.col("window")
    places = cut(met.where(same).select("id", "h1", "h2", start.alias("start"), "k", "item"))
    spans = _covered(places.select("id", "h1", "h2", "start", "k").distinct())
    hit = spans.groupBy("id", "h1", "h2").agg(F.sum("new").alias("n_hit"))
    items = places.groupBy("id", "h1", "h2").agg(F.sort_array(F.collect_set("item")).alias("items"))
    both = hit.join(items.withColumnsRenamed({c: f"_{c}" for c in ("id", "h1", "h2")}), F.col("id").eqNullSafe(F.col("_id")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")))
    both = both.select(F.col("id").alias("_id"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "n_hit", "items")
    rows = found.select("id", "h1", "h2", "n_words").join(both, F.col("id").eqNullSafe(F.col("_id")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left")
    listed = F.array_join(F.coalesce("items", F.array().cast("array<string>")), ",")
    n_hit, n_items = (F.coalesce(c, F.lit(0)).cast("long") for c in (F.col("n_hit"), F.size("items")))
    return rows.select(
        F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), n_items.alias("n_items"), F.sha2(listed, 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12 over all documents and benchmark items."""
    return find_contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words_sql(table: str, key: str) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"SELECT {key}, row_number() OVER () AS rid, regexp_extract_all({lower}, '{_WORD}') AS ws FROM {table}"


ORACLE = f"""
WITH d AS ({_words_sql("documents", "doc_id")}), b AS ({_words_sql("benchmark", "item_id")}),
w AS (SELECT DISTINCT item_id::VARCHAR AS item, k, array_to_string(ws[i:i + k - 1], ' ') AS gram
      FROM (SELECT item_id, ws, least(10, len(ws)) AS k, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
g AS (SELECT rid, k, i, array_to_string(ws[i:i + k - 1], ' ') AS gram
      FROM (SELECT rid, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM w) WHERE len(ws) >= k)),
h AS (SELECT rid, i, w.k, item FROM g JOIN w ON g.k = w.k AND g.gram = w.gram),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM h) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM h GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)"""
