"""Token ids in binary shards with a minimal perfect hash index (operator 3).

A store is a folder that Spark's own writer commits, one row per shard:

- ``payload``: ids of the shard's documents, little-endian, `width` bytes each, end id included;
- ``index``: bytes of ``keys``, ``bounds``, ``seeds``, ``slots`` and ``prints`` (see `_pack_index`).

Looking a key up takes one hash for its bucket's seed, one for its slot, a comparison with the
slot's stored fingerprint, and two reads of ``bounds``: constant time, without reading other keys.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lambi.llm.encoding import encoder, public_path
from lambi.llm.shared import mix, shared_dir

SCHEMA = "part int, shard int, first_key long, last_key long, n_docs int, n_tokens long, width int, index binary, payload binary"
#: Bytes of ids after which a shard is closed.
SHARD_BYTES = 4 << 20
NULL_KEY = -(2**63)
_PRINT = np.uint64(0xA0761D6478BD642F)


def _hash(keys: np.ndarray, seed) -> np.ndarray:
    return mix(keys.view(np.uint64) + np.asarray(seed, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds and slot order of a minimal perfect hash of distinct int64 keys.

    Keys fall into about n/4 buckets; from the largest bucket on, a seed is searched that sends
    its keys to free slots. A bucket of one key stores -1 - slot instead of a seed.
    """
    n = len(keys)
    n_buckets = max(1, n // 4)
    bucket = (_hash(keys, 0) % np.uint64(n_buckets)).astype(np.int64)
    seeds = np.zeros(n_buckets, dtype=np.int32)
    slots = np.full(n, -1, dtype=np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=n_buckets)
    starts = np.cumsum(sizes) - sizes
    trial = np.arange(64, dtype=np.uint64)[:, None]
    single = []
    for b in np.argsort(-sizes, kind="stable"):
        if sizes[b] == 0:
            break
        rows = order[starts[b] : starts[b] + sizes[b]]
        if sizes[b] == 1:
            single.append(b)
            continue
        first = 1
        while True:
            at = (_hash(np.broadcast_to(keys[rows], (64, len(rows))).copy(), trial + np.uint64(first)) % np.uint64(n)).astype(np.int64)
            free = (slots[at] < 0).all(1)
            ranked = np.sort(at, axis=1)
            good = np.flatnonzero(free & (ranked[:, 1:] != ranked[:, :-1]).all(1))
            if len(good):
                seeds[b] = first + good[0]
                slots[at[good[0]]] = rows
                break
            first += 64
    for b, slot in zip(single, np.flatnonzero(slots < 0)):
        seeds[b] = -1 - slot
        slots[slot] = order[starts[b]]
    return seeds, slots


def _pack_index(keys: np.ndarray, lengths: np.ndarray) -> bytes:
    """keys (ascending, repeats allowed) and lengths of a shard's documents -> index bytes.

    A repeated key has one slot; it names the first of its adjacent documents.
    """
    distinct, first = np.unique(keys, return_index=True)
    seeds, slots = build_index(distinct)
    bounds = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
    prints = (_hash(distinct, 0) * _PRINT >> np.uint64(32)).astype("<u4")[slots]
    head = np.array([len(keys), len(distinct), len(seeds)], dtype="<i8")
    return b"".join(x.tobytes() for x in (head, keys.astype("<i8"), bounds, seeds.astype("<i4"), first[slots].astype("<i4"), prints))


def read_index(raw: bytes) -> dict[str, np.ndarray]:
    n, m, b = np.frombuffer(raw, "<i8", 3)
    out, at = {}, 24
    for name, kind, count in (("keys", "<i8", n), ("bounds", "<i8", n + 1), ("seeds", "<i4", b), ("slots", "<i4", m), ("prints", "<u4", m)):
        out[name] = np.frombuffer(raw, kind, count, at)
        at += out[name].nbytes
    return out


def find(index: dict[str, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """First document of each key in the shard, -1 where the stored fingerprint differs."""
    keys = np.ascontiguousarray(keys, dtype=np.int64)
    if not len(index["slots"]):
        return np.full(len(keys), -1)
    h = _hash(keys, 0)
    seed = index["seeds"][(h % np.uint64(len(index["seeds"]))).astype(np.int64)].astype(np.int64)
    at = np.where(seed < 0, -1 - seed, (_hash(keys, np.maximum(seed, 0)) % np.uint64(len(index["slots"]))).astype(np.int64))
    same = index["prints"][at] == (h * _PRINT >> np.uint64(32)).astype(np.uint32)
    return np.where(same, index["slots"][at], -1)


def write_ids(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> str:
    """Encode every whole text and write a store in ascending id order; returns its folder.

    `tokenizer` is a file of the tokenizers library, present on every node; `end_id` (if any)
    ends each document. One range shuffle of the texts orders the documents; a shard never holds
    more than about SHARD_BYTES of ids, unless one document alone is longer.

    A null text is empty (only the end id); a very long one is encoded whole. A null id sorts first
    under NULL_KEY; repeated ids are kept as adjacent documents, in an order that a hash of their
    texts decides, so that many of them spread over several tasks. Further columns are not read, an
    empty table gives an empty store.
    """
    spark = docs.sparkSession
    path = path or shared_dir(spark)
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_KEY)).alias("key"), F.col(text_col).cast("string").alias("body"))
    tied = source.withColumn("tie", F.xxhash64("body"))
    ordered = tied.repartitionByRange(n, "key", "tie").sortWithinPartitions("key", "tie").drop("tie")

    def run(batches):
        enc = encoder(tokenizer)
        part = TaskContext.get().partitionId()
        tail = b"" if end_id is None else enc.pack([end_id])
        keys, blobs, size, shard = [], [], 0, 0

        def flush():
            lengths = np.array([len(x) // enc.width for x in blobs], dtype=np.int64)
            row = [part, shard, keys[0], keys[-1], len(keys), int(lengths.sum()), enc.width, _pack_index(np.array(keys, dtype=np.int64), lengths), b"".join(blobs)]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(row, kinds)], names=[x.split()[0] for x in SCHEMA.split(", ")])

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                texts = [x or "" for x in batch.column(1)[lo : lo + 256].to_pylist()]
                for key, blob in zip(batch.column(0)[lo : lo + 256].to_pylist(), enc.encode(texts)):
                    keys.append(key)
                    blobs.append(blob + tail)
                    size += len(blobs[-1])
                    if size >= SHARD_BYTES:
                        yield flush()
                        keys, blobs, size, shard = [], [], 0, shard + 1
        if keys:
            yield flush()

    ordered.mapInArrow(run, SCHEMA).write.parquet(path)
    return path


def _with_start(shards: DataFrame) -> DataFrame:
    """Ids in all shards before each one: sums of parts first, so that no task sees all shards."""
    per_part = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = per_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    return shards.select("part", "shard", inside.alias("inside"), "n_tokens").join(before, "part").select("part", "shard", (F.col("base") + F.col("inside")).alias("shard_start"))


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Read a store back: doc_id, start, n_tokens, ids_crc32 (and ids), each found by its key.

    Every document's place comes from a lookup of its key in its shard's hash index, and where its
    ids begin and end from that place; one that does not match the stored keys fails the task.
    """
    shards = spark.read.schema(SCHEMA).parquet(path)
    starts = _with_start(shards)
    schema = "part int, shard int, key long, at long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches):
        for batch in batches:
            for part, shard, width, raw, payload in zip(*(batch.column(i).to_pylist() for i in range(5))):
                index = read_index(raw)
                keys, bounds = index["keys"], index["bounds"]
                first, n = find(index, keys), len(keys)
                if (first < 0).any() or not np.array_equal(keys[first], keys):
                    raise ValueError(f"shard {part}/{shard} has a wrong index")
                place = first + np.arange(n) - np.searchsorted(keys, keys)  # of documents that share a key, one after the other
                begin, end = bounds[place], bounds[place + 1]
                ids = np.frombuffer(payload, f"<u{width}").astype("<u4")
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(begin, end)]
                cols = [np.full(n, part, np.int32), np.full(n, shard, np.int32), keys, begin, end - begin, np.array(crc, np.int64)]
                names = ["part", "shard", "key", "at", "n_tokens", "ids_crc32"]
                arrays = [pa.array(x) for x in cols]
                if with_ids:
                    found = np.concatenate([ids[:0], *(ids[a:b] for a, b in zip(begin, end))])
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(end - begin)).astype(np.int32)), pa.array(found.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    docs = shards.select("part", "shard", "width", "index", "payload").mapInArrow(run, schema)
    out = docs.join(starts, ["part", "shard"])
    return out.select(F.when(F.col("key") != NULL_KEY, F.col("key")).alias("doc_id"), (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] * with_ids))


def lookup(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """Ids of documents by key (a list that fits a task), a row for each document with one.

    Shards that can't hold a key are skipped by their bounds. The indexes of the others give byte
    ranges, and only those ranges of the payloads are read on.
    """
    wanted = np.array(sorted(set(keys)), dtype=np.int64)
    shards = spark.read.schema(SCHEMA).parquet(path)
    near = shards.where(F.exists(F.array(*map(F.lit, wanted.tolist())).cast("array<long>"), lambda k: k.between(F.col("first_key"), F.col("last_key"))))

    def places(batches):
        for batch in batches:
            rows = []
            for part, shard, width, raw in zip(*(c.to_pylist() for c in batch.columns)):
                index = read_index(raw)
                for key, first in zip(wanted.tolist(), find(index, wanted).tolist()):
                    if first >= 0 and index["keys"][first] == key:
                        for r in range(first, int(np.searchsorted(index["keys"], key, "right"))):
                            a, b = (int(x) * width for x in index["bounds"][r : r + 2])
                            rows.append((part, shard, key, width, a, b - a))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 6, kinds)], names=["part", "shard", "doc_id", "width", "first", "size"])

    def decode(batches):
        for batch in batches:
            ids = [np.frombuffer(raw, f"<u{width}").astype(np.int32) for width, raw in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    spots = near.select("part", "shard", "width", "index").mapInArrow(places, "part int, shard int, doc_id long, width int, first long, size long")
    pieces = spots.join(near.select("part", "shard", "payload"), ["part", "shard"])
    return pieces.selectExpr("doc_id", "width", "substring(payload, CAST(first AS INT) + 1, CAST(size AS INT)) AS bytes").mapInArrow(decode, "doc_id long, ids array<int>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3 over all documents: write the store, read it back."""
    return read_ids(spark, write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_path("byte_bpe_50k.json")))
