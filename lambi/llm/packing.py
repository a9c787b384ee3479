"""Packing of token sequences by exact complements (operator 8)."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lambi.llm.encoding import encoder, public_path
from lambi.llm.shared import cut, text_slices

#: Words that a worker's encoder remembers, about 0.3 KB each.
WORDS_KEPT = 1 << 18
#: Rows of ids that are decoded together.
DECODED = 512
PIECE = "doc_id {}, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode whole texts, append the end id and cut documents longer than `size` into pieces.

    One row per piece; a null or empty text is one piece holding only the end id. Null ids and
    repeated rows are documents like others, each with its own pieces; very long texts are encoded
    whole. Further columns are not read. An empty table gives an empty result. With `with_ids`, the
    ids as bytes of the tokenizer's width.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("body"))
    schema = PIECE.format(source.schema["doc_id"].dataType.simpleString()) + ", ids binary" * with_ids

    def run(batches):
        enc = encoder(tokenizer, WORDS_KEPT)
        tail = enc.pack([end_id])
        for batch in batches:
            for lo, hi, *_ in text_slices(batch.column(1), rows=256):
                rows, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, blob in enumerate(enc.encode([x or "" for x in batch.column(1)[lo:hi].to_pylist()])):
                    wide = np.frombuffer(blob + tail, enc.kind).astype("<u4")
                    for k, a in enumerate(range(0, len(wide), size)):
                        part = wide[a : a + size]
                        rows.append(lo + i)
                        piece.append(k)
                        start.append(a)
                        length.append(len(part))
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(part.astype(enc.kind).tobytes())
                arrays = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array(ids, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return source.mapInArrow(run, schema)


class _Sums:
    """Available lengths by the sum of two and of three of them, longest parts first.

    `two` and `three` hold the largest part of a pair or triple for each sum, 0 where there is none.
    Counts only fall while combinations are consumed, so an entry whose lengths ran out moves on to
    the next smaller part and never back.
    """

    def __init__(self, count: np.ndarray):
        self.count, n = count, len(count)
        self.two, self.three = np.zeros(n, np.int64), np.zeros(n, np.int64)
        have = np.flatnonzero(count)
        for a in have:
            other = have[have <= min(a, n - 1 - a)]
            self.two[a + other[(other < a) | (count[a] > 1)]] = a
        pairs = np.flatnonzero(self.two)
        for c in have:
            self.three[c + pairs[pairs < n - c]] = c

    def find(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three available lengths of sum `gap`."""
        if self.count[gap]:
            return (gap,)
        return self.pair(gap) or self.triple(gap)

    def pair(self, gap: int, held: int = 0) -> tuple[int, int] | None:
        """Two lengths of sum `gap`, while a piece of length `held` is taken."""
        a = self.two[gap] = self._larger(gap, int(self.two[gap]))
        if held and a and held in (a, gap - a):
            self.count[held] -= 1
            a = self._larger(gap, int(a))
            self.count[held] += 1
        return (int(a), int(gap - a)) if a else None

    def _larger(self, gap: int, a: int) -> int:
        """The larger part, at most `a`, of the pair of sum `gap` that comes next; 0 if none does."""
        count = self.count
        if not a or count[a] and count[gap - a] and (2 * a != gap or count[a] > 1):
            return a
        parts = np.arange((gap + 1) // 2, a + 1)
        here = (count[parts] > 0) & (count[gap - parts] > 0) & ((2 * parts != gap) | (count[parts] > 1))
        return int(parts[here][-1]) if here.any() else 0

    def triple(self, gap: int) -> tuple[int, int, int] | None:
        c = int(self.three[gap])
        rest = None
        while c:
            rest = self.pair(gap - c, held=c) if self.count[c] else None
            if rest:
                break
            parts = np.arange(1, c)
            here = parts[(self.count[parts] > 0) & (self.two[gap - parts] > 0)]
            c = int(here[-1]) if len(here) else 0
        self.three[gap] = c
        return (c, *rest) if rest else None


def _exact(count: np.ndarray, size: int):
    """Consume combinations that fill a sequence exactly; yields (lengths, times).

    A length leads until its gap has no complement among the sums; then no combination left holds
    it, so that parts are at most as long as their lead.
    """
    whole = int(count[size])
    if whole:
        count[size] = 0
        yield (size,), whole
    sums = _Sums(count)
    for lead in range(size - 1, 0, -1):
        while count[lead]:
            count[lead] -= 1
            found = sums.find(size - lead)
            count[lead] += 1
            if found is None:
                break
            parts = (lead, *found)
            need = np.bincount(parts)
            times = int(min(count[x] // need[x] for x in set(parts)))
            for x in parts:
                count[x] -= times
            yield parts, times


def _best_fit(count: np.ndarray, size: int):
    """Best fit of what is left, longest first, whole runs of equal lengths at a time."""
    open_bins: dict[int, list[list]] = {}  # gap -> [lengths, times]
    gaps = np.zeros(size + 1, dtype=np.int64)
    for length in range(size, 0, -1):
        left = int(count[length])
        count[length] = 0
        while left:
            fit = length + int(np.argmax(gaps[length:] > 0)) if gaps[length:].any() else None
            if fit is None:
                per = min(size // length, left)
                times = left // per
                parts, gap, n = (length,) * per, size - per * length, times
                left -= per * times
            else:
                parts, times = open_bins[fit].pop()
                gaps[fit] -= times
                n = min(left, times)
                if times > n:
                    open_bins[fit].append([parts, times - n])
                    gaps[fit] += times - n
                left -= n
                parts, gap = (*parts, length), fit - length
            open_bins.setdefault(gap, []).append([parts, n])
            gaps[gap] += n
    for bins in open_bins.values():
        for parts, times in bins:
            yield tuple(parts), times


def plan(counts: dict[int, int], size: int) -> np.ndarray:
    """Where runs of equally long pieces go. Columns: length, first rank, ranks, first sequence,
    places a sequence, offset.

    The plan needs only how many pieces have each length: at most `size` numbers, whatever the
    table's size. Rank r of a run goes to sequence first + (r - first rank) // places at offset +
    ((r - first rank) % places) * length.
    """
    count = np.zeros(size + 1, dtype=np.int64)
    for k, v in counts.items():
        count[k] = v
    used, runs, sequence = np.zeros(size + 1, dtype=np.int64), [], 0
    for step in (_exact, _best_fit):
        for parts, times in step(count, size):
            at = 0
            for x in sorted(set(parts), reverse=True):
                places = parts.count(x)
                runs.append((x, used[x], places * times, sequence, places, at))
                used[x] += places * times
                at += places * x
            sequence += times
    return np.array(sorted(runs), dtype=np.int64).reshape(-1, 6)


def _decoded(column: pa.Array, lengths: np.ndarray) -> pa.Array:
    """Rows of ids as bytes, equally wide, as lists of ints."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    width = int(offsets[-1] - offsets[0]) // int(lengths.sum())
    ids = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(f"<u{width}").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(((offsets - offsets[0]) // width).astype(np.int32)), pa.array(ids))


def pack(pieces: DataFrame, size: int, salts: int | None = None, ids: str | None = None) -> DataFrame:
    """Add sequence_id and offset to a table of pieces (doc_id, piece, length of 1 to `size`).

    Only the counts of each length go to the driver (at most `size` numbers); the plan comes back
    as at most a few runs per length. Ranks are row numbers within (length, salt) plus the counts
    of the salts before (salts grow with the rows / 2**20), so that no task holds a whole length,
    however many pieces share it. A column `ids` of bytes comes back as an array of ints, from the
    same Python step, so that a task needs one worker.

    Ties are dealt by (doc_id, piece) and, for repeated rows, arbitrarily: equal rows are
    interchangeable. An empty table gives an empty result.
    """
    pieces = cut(pieces)
    spark = pieces.sparkSession
    if salts is None:
        salts = max(64, pieces.count() >> 20)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(salts)))
    cells = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = plan(counts, size)
    by_length = {int(x): runs[runs[:, 0] == x] for x in np.unique(runs[:, 0])}
    key = spark.sparkContext.broadcast(by_length)
    before = cells.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start")) - 1
    ranked = salted.withColumn("inside", inside).join(before, ["length", "salt"])
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    out = ranked.select(*names, (F.col("before") + F.col("inside")).alias("rank"))
    schema = ", ".join(f"`{f.name}` {'array<int>' if f.name == ids else f.dataType.simpleString()}" for f in pieces.schema if f.name in names) + ", sequence_id long, offset long"

    def run(batches):
        for batch in batches:
            lengths = batch.column(names.index("length")).to_numpy()
            rank = batch.column(len(names)).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(lengths):
                rows = np.flatnonzero(lengths == x)
                own = key.value[int(x)]
                r = own[np.searchsorted(own[:, 1], rank[rows], side="right") - 1]
                past = rank[rows] - r[:, 1]
                sequence[rows] = r[:, 3] + past // r[:, 4]
                offset[rows] = r[:, 5] + past % r[:, 4] * x
            step = DECODED if ids else max(1, batch.num_rows)
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                own = [_decoded(c, lengths[lo : lo + step]) if name == ids else c for name, c in zip(names, part.columns)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(sequence[lo : lo + step]), pa.array(offset[lo : lo + step])], names=[*names, "sequence_id", "offset"])

    return out.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, size: int = 2048, with_ids: bool = False) -> DataFrame:
    """Encode, cut and pack whole documents (see `token_pieces` and `pack`); with `with_ids`, a column
    of the ids, which are shuffled as bytes of the tokenizer's width."""
    return pack(token_pieces(docs, tokenizer, end_id, size, with_ids=with_ids), size, ids="ids" if with_ids else None)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8 over all documents."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_path("word_bpe_49k.json"))
