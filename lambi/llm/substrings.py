"""Removal of repeated byte strings across documents (operator 5).

A string of LENGTH bytes that occurs twice has, in both places, the same anchor: the GRAM-byte
piece of least hash in it. So strings are dealt by anchor, and only those whose anchor occurs
again are looked at. Where whole stretches agree, the first one stands for all; the others are
sorted into suffix order, and breadth-first backward extension on their Burrows-Wheeler
transform finds the strings of LENGTH bytes that are equal.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lambi.llm.shared import KeyFilter, cut, mix, range_hashes, signed, text_slices

LENGTH = 100
#: Bytes of an anchor; a stretch is the run of strings that share one occurrence of it.
GRAM = 32
#: Stretches of one key that are sorted together; more are split by what they contain.
TOGETHER = 256
#: Strings that a key covers: first all with the anchor, then those within so many places.
WIDTHS = (LENGTH, 25, 5, 1)
#: Bytes that one suffix sort holds (it ends between keys).
SORT_BYTES = 1 << 19
_ODD = [np.uint64(0x9E3779B97F4A7C15 + 2 * i * 0x51ED270B) for i in range(6)]
_LETTERS = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Stretches of a slice: anchor hash, hash of the whole stretch, row, start in the row,
    strings in it, and the anchor's place after the start."""
    n = len(data)
    if n < length:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(5)))
    h = _LETTERS[data]
    step = 1
    for odd in _ODD[: gram.bit_length() - 1]:
        h = h[:-step] * odd + h[step:]
        step *= 2
    h = mix(h)
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    width, step = length - gram + 1, 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < width:
        least = np.minimum(least[: len(least) - (width - step)], least[width - step :])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    whole = np.zeros(n - length + 1, dtype=bool)
    size = np.diff(offsets)
    for a, b in zip(offsets[:-1][size >= length].tolist(), offsets[1:][size >= length].tolist()):
        whole[a : b - length + 1] = True
    new = whole.copy()
    new[1:] &= ~whole[:-1] | (at[1:] != at[:-1])
    ends = whole.copy()
    ends[:-1] &= ~whole[1:] | (at[1:] != at[:-1])
    first, last = np.flatnonzero(new), np.flatnonzero(ends)
    anchor = at[first]
    content = range_hashes(data, first, last + length) ^ mix((anchor - first).astype(np.uint64))
    row = np.searchsorted(offsets, first, side="right") - 1
    return h[anchor], signed(content), row, first - offsets[row], last - first + 1, anchor - first


def equal_strings(data: np.ndarray, separator: int, length: int = LENGTH) -> np.ndarray:
    """Suffix order and cuts of `data`, whose pieces end with the separator byte.

    Returns (order, cut): neighbours in the order without a cut between them begin with the same
    `length` bytes (meant for suffixes that have as many before a separator).

    Suffixes are sorted by at least `length` bytes (prefix doubling). Intervals of the strings c·w
    follow from those of w by the first and last place of c in the transform; all strings of one
    length are extended at once, those of length 1 first, so common prefixes come by increasing
    value. An interval whose two ends are known already needs no extension, and the search stops
    at `length`: what is not cut by then is equal.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : n + i]
    depth = 8
    while True:
        order = np.argsort(key)
        ranked = key[order]
        step = np.append(True, ranked[1:] != ranked[:-1])
        rank = np.empty(n, dtype=np.uint64)
        rank[order] = np.cumsum(step).astype(np.uint64)
        if depth >= length or step.all():
            break
        key = rank << np.uint64(32)
        key[: n - depth] |= rank[depth:]
        depth *= 2
    before = data[order - 1]
    by_letter = np.argsort(before, kind="stable")
    letters = before[by_letter]
    place = np.empty(n, dtype=np.int64)  # where the suffix one byte longer stands
    place[by_letter] = np.arange(n)
    again = np.append(False, letters[1:] == letters[:-1])
    earlier, later = np.full(n, -1), np.full(n, n)
    earlier[by_letter[1:]] = np.where(again[1:], by_letter[:-1], -1)
    later[by_letter[:-1]] = np.where(again[1:], by_letter[1:], n)
    text = before != separator
    cut_at = np.zeros(n + 1, dtype=bool)
    cut_at[[0, n]] = True
    first = np.flatnonzero(~again)
    low, high = first, np.append(first[1:], n) - 1
    use = letters[first] != separator
    low, high = low[use], high[use]
    cut_at[low] = cut_at[high + 1] = True
    for _ in range(1, length):
        if not len(low):
            break
        size = high - low + 1
        inside = np.arange(int(size.sum())) + np.repeat(low - (np.cumsum(size) - size), size)
        begins = inside[(earlier[inside] < np.repeat(low, size)) & text[inside]]
        ends = inside[(later[inside] > np.repeat(high, size)) & text[inside]]
        low, high = np.sort(place[begins]), np.sort(place[ends])
        new = ~(cut_at[low] & cut_at[high + 1])
        low, high = low[new], high[new]
        cut_at[low] = cut_at[high + 1] = True
    return order, cut_at[:-1]


def _repeats(docs: np.ndarray, starts: np.ndarray, counts: np.ndarray, bodies: list[bytes], length: int):
    """Runs (doc, start, strings) of the stretches' strings that also begin earlier in one of them."""
    data = np.frombuffer(b"\xff".join(bodies) + b"\xff", dtype=np.uint8)
    size = counts + length - 1
    first = np.cumsum(size + 1) - (size + 1)
    order, cuts = equal_strings(data, 0xFF, length)
    piece = np.searchsorted(first, order, side="right") - 1
    inner = order - first[piece]
    group = np.cumsum(cuts)
    good = np.flatnonzero(inner < counts[piece])
    group, piece, inner = group[good], piece[good], inner[good]
    same = np.append(group[1:] == group[:-1], False)
    shared = same | np.append(False, same[:-1])
    group, piece, inner = group[shared], piece[shared], inner[shared]
    ranked = np.lexsort((starts[piece] + inner, docs[piece], group))
    group, piece, inner = group[ranked], piece[ranked], inner[ranked]
    at = starts[piece] + inner
    lead = np.append(True, group[1:] != group[:-1]) if len(group) else np.zeros(0, bool)
    head = np.maximum.accumulate(np.where(lead, np.arange(len(group)), 0))
    late = (docs[piece] != docs[piece][head]) | (at != at[head])
    piece, inner = piece[late], inner[late]
    ranked = np.lexsort((inner, piece))
    piece, inner = piece[ranked], inner[ranked]
    begin = np.flatnonzero(np.append(True, (piece[1:] != piece[:-1]) | (inner[1:] != inner[:-1] + 1))) if len(piece) else np.zeros(0, np.int64)
    runs = np.diff(np.append(begin, len(piece)))
    return docs[piece[begin]], starts[piece[begin]] + inner[begin], runs


def _batch(names, *columns):
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _stretches(docs: DataFrame, length: int, gram: int, wanted=None) -> DataFrame:
    """Stretches of all texts; with a broadcast filter, those whose anchors it lets pass."""
    names = ["anchor", "content", "doc", "start", "strings", "place"]

    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(1)):
                anchor, content, row, start, strings, place = anchors(data, offsets, length, gram)
                use = np.flatnonzero(wanted.value.has(signed(anchor))) if wanted is not None else slice(None)
                anchor, content, row, start, strings, place = (x[use] for x in (anchor, content, row, start, strings, place))
                yield _batch(names, signed(anchor), content, batch.column(0)[lo:hi].to_numpy()[row], start, strings.astype(np.int32), place.astype(np.int32))

    return docs.mapInArrow(run, "anchor long, content long, doc long, start long, strings int, place int")


def _with_bodies(stretches: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """Add the bytes of stretches (key, doc, start, strings, place): one join with the texts."""
    own = stretches.groupBy("doc").agg(F.collect_list(F.struct("key", "start", "strings", "place")).alias("held"))

    def run(batches):
        for batch in batches:
            for doc, body, held in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                body = body.as_py().encode()
                held = held.as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["key"] for r in held], pa.int64()), pa.array([doc] * len(held), pa.int64()), pa.array([r["start"] for r in held], pa.int64()), pa.array([r["strings"] for r in held], pa.int32()),
                     pa.array([r["place"] for r in held], pa.int32()), pa.array([body[r["start"] : r["start"] + r["strings"] + length - 1] for r in held], pa.binary())],
                    names=["key", "doc", "start", "strings", "place", "bytes"])

    return docs.join(own, "doc").select("doc", "body", "held").mapInArrow(run, "key long, doc long, start long, strings int, place int, bytes binary")


def _split(stretches: DataFrame, width: int, length: int) -> DataFrame:
    """Cut stretches into runs of strings whose places differ by less than `width`; the new key is
    what all strings of a run have in common, besides the old key."""

    def run(batches):
        for batch in batches:
            out = []
            for key, doc, start, strings, place, body in zip(*(c.to_pylist() for c in batch.columns)):
                j = 0
                while j < strings:
                    q = (place - j) // width
                    stop = min(strings, place - q * width + 1)
                    common = body[max(place - q * width, 0) : place - (q * width + width - 1) + length]
                    new = int.from_bytes(hashlib.blake2b(common + b"%d %d" % (q, key), digest_size=8).digest(), "little", signed=True)
                    out.append((new, doc, start + j, stop - j, place - j, body[j : stop + length - 1]))
                    j = stop
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 6, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))], names=["key", "doc", "start", "strings", "place", "bytes"])

    return stretches.mapInArrow(run, "key long, doc long, start long, strings int, place int, bytes binary")


def _sorted_repeats(stretches: DataFrame, length: int) -> DataFrame:
    """Repeats among stretches of keys that have at most TOGETHER of them."""

    def run(batches):
        held, size, last = [], 0, None

        def flush():
            doc, start, strings, body = zip(*held)
            return _batch(["doc", "start", "strings"], *_repeats(np.array(doc, np.int64), np.array(start, np.int64), np.array(strings, np.int64), list(body), length))

        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= SORT_BYTES and key != last:
                    yield flush()
                    held, size = [], 0
                held.append(row)
                size += len(row[3]) + 1
                last = key
        if held:
            yield flush()

    n = int(stretches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = stretches.select("key", "doc", "start", "strings", "bytes").repartition(n, "key").sortWithinPartitions("key")
    return near.mapInArrow(run, "doc long, start long, strings long")


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc, start, strings): runs of starts of `length`-byte strings that also start earlier.

    `docs` has doc (long, not null) and body (string, not null). Earlier means a smaller doc, or
    the same doc and a smaller start. Runs of one document may touch or overlap.
    """
    again = cut(_stretches(docs, length, gram).groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"))
    wanted = docs.sparkSession.sparkContext.broadcast(KeyFilter(again, "anchor"))
    met = cut(_stretches(docs, length, gram, wanted).join(again, "anchor"))
    wanted.destroy()
    kinds = cut(met.groupBy("anchor", "content").agg(F.min(F.struct("doc", "start", "strings", "place")).alias("lead"), F.count(F.lit(1)).alias("n")))
    several = kinds.where("n > 1").select("anchor", "content", F.col("lead.doc").alias("lead_doc"), F.col("lead.start").alias("lead_start"))
    copies = met.join(several, ["anchor", "content"]).where((F.col("doc") != F.col("lead_doc")) | (F.col("start") != F.col("lead_start")))
    parts = [copies.select("doc", "start", F.col("strings").cast("long").alias("strings"))]
    leads = kinds.select(F.col("anchor").alias("key"), "lead.*")
    sizes = cut(leads.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    if not sizes.isEmpty():
        open_leads = leads.join(sizes, "key").select("key", "doc", "start", "strings", "place")
        rest = cut(_with_bodies(open_leads, docs, length))
        for width in WIDTHS[1:]:
            sized = rest.join(sizes, "key")
            parts.append(cut(_sorted_repeats(sized.where(F.col("size") <= TOGETHER), length)))
            big = sized.where(F.col("size") > TOGETHER).drop("size")
            pieces = cut(_split(big, width, length).withColumn("content", F.xxhash64("bytes", "place")))
            kinds = cut(pieces.groupBy("key", "content").agg(F.min(F.struct("doc", "start")).alias("lead"), F.count(F.lit(1)).alias("n")))
            both = pieces.join(kinds, ["key", "content"])
            is_lead = (F.col("doc") == F.col("lead.doc")) & (F.col("start") == F.col("lead.start"))
            parts.append(both.where(~is_lead).select("doc", "start", F.col("strings").cast("long").alias("strings")))
            rest = both.where(is_lead).drop("lead", "n", "content")
            sizes = cut(kinds.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
            if sizes.isEmpty():  # at width 1 all pieces of a key are equal
                break
    out = parts[0]
    for x in parts[1:]:
        out = out.union(x)
    return out


def _spans(starts: np.ndarray, strings: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal removed byte ranges of a document's runs; touching ranges are one."""
    order = np.argsort(starts)
    a, b = starts[order], np.maximum.accumulate(starts[order] + strings[order] + length - 1)
    new = np.append(True, a[1:] > b[:-1])
    return a[new], np.append(b[:-1][new[1:]], b[-1])


def _in_order(rows: DataFrame) -> tuple[DataFrame, bool]:
    """Rows with `doc`, a number in the order of ids (null `key` first), and whether rows share one.

    Distinct ids are those numbers. Where rows share an id, the distinct pairs of id and text are
    numbered, equal ids by a hash of their texts, so that equal rows share a number: by range
    partitions, from the pairs before a partition and those before the pair in it.
    """
    if rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or key is null").isEmpty():
        return rows.withColumn("doc", F.col("key")), False
    held = F.coalesce("body", F.lit(""))
    hashed = rows.withColumns({"_id": F.coalesce("key", F.lit(-(2**63))), "_null": F.col("key").isNotNull(), "_a": F.xxhash64(held), "_b": F.xxhash64(held, F.lit(1))})
    own = ["_null", "_id", "_a", "_b"]
    pairs = hashed.select(*own).distinct().repartitionByRange(*own).sortWithinPartitions(*own)

    def number(batches):
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            size = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(size, part, np.int32)), pa.array(np.arange(n, n + size))], names=[*own, "part", "seq"])
            n += size

    numbered = cut(pairs.mapInArrow(number, "_null boolean, _id long, _a long, _b long, part int, seq long"))
    sizes = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    places = numbered.join(F.broadcast(before), "part").select(*own, (F.col("before") + F.col("seq")).alias("doc"))
    return hashed.join(places, own).drop(*own), True


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Remove every byte that a `length`-byte string covers which also starts earlier.

    Texts are taken as UTF-8 bytes; strings never cross documents and are judged on the input.
    Result, a row per input row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 of the remaining bytes; with `with_text` also `text`, what remains as text
    (a character of which only some bytes remain is left out), null where the text was null; with
    `carry`, a struct `carried` of those columns of the same input row.

    A null or empty text has no bytes; a very long one is a row like others. Null ids come first in
    the order of documents. Rows that share an id, null ids too, follow each other in an order that
    their texts decide, each text judged as a document of its own; equal rows share a place, so that
    none of them is earlier. Further columns are not read. An empty table gives an empty result.
    """
    carried = [F.struct(*carry).alias("carried")] if carry else []
    rows, shared = _in_order(docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).cast("string").alias("body"), *carried))
    full = rows.where(F.octet_length("body") >= length).select("doc", "body")
    full = full.dropDuplicates(["doc"]) if shared else full
    runs = repeated_runs(full, length, gram).groupBy("doc").agg(F.collect_list(F.struct("start", "strings")).alias("runs"))

    def apply(batches):
        for part in (batch.slice(lo, hi - lo) for batch in batches for lo, hi, *_ in text_slices(batch.column(1))):
            out = []
            for body, runs in zip(part.column(1), part.column(2)):
                null = not body.is_valid
                body = b"" if null else body.as_py().encode()
                n, removed, spans, kept = len(body), 0, 0, body
                if runs.is_valid:
                    flat = runs.values
                    a, b = _spans(flat.field(0).to_numpy(), flat.field(1).to_numpy(), length)
                    a, b = np.minimum(a, n), np.minimum(b, n)
                    a, b = a[b > a], b[b > a]
                    removed, spans = int((b - a).sum()), len(a)
                    kept = b"".join(body[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), n]))
                row = [n, removed, spans, hashlib.sha256(kept).hexdigest()]
                if with_text:
                    row.append(None if null else kept.decode(errors="ignore"))
                out.append(row)
            columns = list(zip(*out)) or [[]] * (4 + with_text)
            kinds = [pa.int64()] * 3 + [pa.string()] * (1 + with_text)
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds)), *part.columns[3:]], names=[f.name for f in schema])

    met = rows.join(runs, "doc", "left").select("key", "body", "runs", *(["carried"] if carry else []))
    schema = StructType.fromDDL("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", text string" * with_text)
    schema = StructType(schema.fields + met.schema.fields[3:])
    return met.mapInArrow(apply, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5 over all documents."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
