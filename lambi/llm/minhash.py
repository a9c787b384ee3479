"""Near-duplicate texts by HyperMinHash sketches (operator 2)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lambi.llm.graph import components
from lambi.llm.shared import LOWER, cut, mix, range_hashes, signed, text_slices, word_spans

#: Buckets of a sketch, registers in a band, bands. At a similarity of 0.8 a pair shares no band
#: with probability (1 - 0.8**5)**40 = 1.2e-7; texts of a few shingles borrow registers, and more
#: often share none (1 of 4000 simulated pairs with 4 of 5 shingles in common).
BUCKETS, BAND, BANDS = 256, 5, 40
#: Bits after the leading one that a register keeps.
MANTISSA = 10
#: Least shingles of a document that the comparison within bands looks at.
LOWEST = 512
#: Rows of a sub-block when a band's documents are compared with each other.
TILE = 512
_PROBES = 48


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct (row << 52 | 52-bit hash of k lower-cased words); a text of fewer words
    gives its whole sequence. At most 4096 rows."""
    data = LOWER[data]
    begin, end, row = word_spans(data, offsets)
    h = range_hashes(data, begin, end)
    n = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(n) - n
    rolled = np.zeros(len(h), dtype=np.uint64)
    place = np.arange(len(h)) - first[row]
    for i in range(k):
        nxt = np.minimum(np.arange(len(h)) + i, max(len(h) - 1, 0))
        rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + np.where(place + i < n[row], h[nxt], np.uint64(0)) if len(h) else rolled
    use = (place + k <= n[row]) | (place == 0)
    keys = (row[use].astype(np.uint64) << np.uint64(52)) | (mix(rolled[use] + n[row][use].clip(max=k).astype(np.uint64)) >> np.uint64(12))
    keys.sort()
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def _probe_order() -> np.ndarray:
    tries = np.arange(_PROBES, dtype=np.uint64)[:, None] * np.uint64(1 << 20) + np.arange(BUCKETS, dtype=np.uint64)
    return (mix(tries + np.uint64(99)) % np.uint64(BUCKETS)).astype(np.int64)


def sketch(keys: np.ndarray, n_rows: int):
    """Set sizes, two 64-bit set hashes and registers (rows x BUCKETS, uint16) of shingle sets.

    Each shingle falls into one bucket; the bucket's least value is stored as leading zeros and
    MANTISSA further bits. An empty bucket takes the register of the first filled bucket in a
    fixed pseudo-random order, the same for all texts. Sketches of empty sets are all ones.
    """
    row = (keys >> np.uint64(52)).astype(np.int64)
    shingle = keys & np.uint64((1 << 52) - 1)
    size = np.bincount(row, minlength=n_rows)
    once = mix(shingle + np.uint64(0x1234567))
    twice = mix(once ^ np.uint64(0x6A09E667F3BCC909))
    sums = []
    for x in (once, twice):
        total = np.zeros(len(x) + 1, dtype=np.uint64)
        np.cumsum(x, out=total[1:])
        stop = np.cumsum(size)
        sums.append(mix(total[stop] - total[stop - size] + size.astype(np.uint64)))
    value = mix(shingle ^ np.uint64(0xBB67AE8584CAA73B))
    slot = (keys >> np.uint64(52) << np.uint64(8)) | (value & np.uint64(BUCKETS - 1))
    packed = (slot << np.uint64(44)) | (value >> np.uint64(20))
    packed.sort()
    slots = (packed >> np.uint64(44)).astype(np.int64)
    first = np.append(True, slots[1:] != slots[:-1]) if len(slots) else np.zeros(0, bool)
    least = (packed[first] & np.uint64((1 << 44) - 1)) | np.uint64(1)
    exponent = np.frexp(least.astype(np.float64))[1]  # bits in use
    zeros = 44 - exponent
    tail = np.where(exponent > MANTISSA, least >> np.maximum(exponent - 1 - MANTISSA, 0).astype(np.uint64), least << np.maximum(MANTISSA + 1 - exponent, 0).astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)
    registers = np.full(n_rows * BUCKETS, 0xFFFF, dtype=np.uint16)
    registers[slots[first]] = (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | tail.astype(np.uint16)
    registers = registers.reshape(n_rows, BUCKETS)
    filled = registers != 0xFFFF
    lacking = np.flatnonzero(~filled.all(1) & filled.any(1))
    if len(lacking):
        own, done, have = registers[lacking], filled[lacking].copy(), filled[lacking]
        for order in _probe_order():
            take = ~done & have[:, order]
            own[take] = np.take(registers[lacking], order, axis=1)[take]
            done |= take
            if done.all():
                break
        if not done.all():  # very few filled buckets: the next filled one
            at = np.where(have, np.arange(BUCKETS), 2 * BUCKETS)
            at = np.minimum.accumulate(np.concatenate([at, at + BUCKETS], axis=1)[:, ::-1], axis=1)[:, ::-1][:, :BUCKETS] % BUCKETS
            own[~done] = np.take_along_axis(registers[lacking], at, axis=1)[~done]
        registers[lacking] = own
    return size, sums[0], sums[1], registers


def similarity(a: np.ndarray, b: np.ndarray, collisions: float = 2.0 ** -(MANTISSA + 1)) -> np.ndarray:
    """Jaccard estimate of two register arrays, corrected for registers equal by chance."""
    same = (a == b).mean(-1)
    return np.clip((same - collisions) / (1 - collisions), 0, 1)


def _sketches(docs: DataFrame, k: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(1)):
                size, one, two, registers = sketch(shingle_sets(data, offsets, k), hi - lo)
                raw = pa.Array.from_buffers(pa.binary(2 * BUCKETS), hi - lo, [None, pa.py_buffer(registers.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(size), pa.array(signed(one)), pa.array(signed(two)), raw], names=["doc_id", "n", "s1", "s2", "registers"])

    return docs.mapInArrow(run, "doc_id long, n long, s1 long, s2 long, registers binary")


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS)


def _band_keys(registers: np.ndarray) -> np.ndarray:
    """A key for each band of each sketch (rows x BANDS)."""
    registers = registers[:, : BAND * BANDS].reshape(len(registers), BANDS, BAND).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), registers.shape[:2]).copy()
    for i in range(BAND):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + registers[:, :, i])
    return signed(key)


def _bands(sketches: DataFrame) -> DataFrame:
    """(band key, doc_id, n) for each band of each sketch."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                repeat = lambda c: np.repeat(c.to_numpy(), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(_band_keys(_registers(part.column(2))).ravel()), pa.array(repeat(part.column(0))), pa.array(repeat(part.column(1)))], names=["band", "doc_id", "n"])

    return sketches.select("doc_id", "n", "registers").mapInArrow(run, "band long, doc_id long, n long")


def _lowest(rows: DataFrame, k: int) -> DataFrame:
    """(doc_id, low): the LOWEST smallest shingle hashes of each text, 32 bits each, ascending."""

    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(1)):
                keys = shingle_sets(data, offsets, k)
                row = (keys >> np.uint64(52)).astype(np.int64)
                low = ((keys & np.uint64((1 << 52) - 1)) >> np.uint64(20)).astype("<u4")
                stop = np.searchsorted(row, np.arange(hi - lo), side="right")
                start = np.searchsorted(row, np.arange(hi - lo), side="left")
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array([low[a : min(b, a + LOWEST)].tobytes() for a, b in zip(start, stop)], pa.binary())], names=["doc_id", "low"])

    return rows.mapInArrow(run, "doc_id long, low binary").dropDuplicates(["doc_id"])


def _may_link(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, percent: int) -> bool:
    """Whether two documents can reach the similarity, by their least shingles: nearly exact where
    those are all, else up to five standard deviations of the estimate."""
    both = np.concatenate([a, b])
    both.sort()
    again = both[1:] == both[:-1]
    common = int(again.sum())
    if max(n_a, n_b) <= LOWEST:
        return 100 * common >= (percent - 1) * (len(both) - common)
    size = min(LOWEST, len(both) - common)
    distinct = both[np.append(True, ~again)]
    common = int((both[1:][again] <= distinct[size - 1]).sum())
    return common / size >= percent / 100 - 5 * (percent / 100 * (1 - percent / 100) / size) ** 0.5


def _remainders(lows: list[np.ndarray]) -> np.ndarray:
    """How many least shingles of each text leave each remainder modulo BUCKETS (rows x BUCKETS)."""
    row = np.repeat(np.arange(len(lows)), [len(x) for x in lows])
    slot = row * BUCKETS + (np.concatenate(lows) & np.uint32(BUCKETS - 1)).astype(np.int64)
    return np.bincount(slot, minlength=len(lows) * BUCKETS).reshape(-1, BUCKETS).astype(np.int16)


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of which 100 * intersection >= percent * union holds on the full sets."""
    side = lambda x: texts.select(F.col("doc_id").alias(x), F.col("body").alias(f"body_{x}"))

    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(2), rows=1024):
                one = shingle_sets(data, offsets, k)
                two = [shingle_sets(d, o, k) + (np.uint64(x) << np.uint64(52)) for x, _, d, o in text_slices(batch.column(3)[lo:hi], rows=1024)]
                both = np.concatenate([one, *two])
                both.sort()
                n = hi - lo
                rows = lambda x: np.bincount((x >> np.uint64(52)).astype(np.int64), minlength=n)
                common = rows(both[1:][both[1:] == both[:-1]])
                union = rows(both) - common
                yield batch.select(["a", "b"]).slice(lo, n).filter(pa.array((100 * common >= percent * union) & (union > 0)))

    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "body_a", "body_b").mapInArrow(run, "a long, b long")


def _close(a: str, b: str, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _cross_pairs(members: DataFrame, sketches: DataFrame, rows: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs of one band but different components that may well be links.

    A band's documents are packed into tiles of TILE rows; tiles of one band meet two by two, so
    that no task holds a large band. A pair is looked at in the first band it shares, first by
    its registers, then by its least shingles; only pairs that pass are emitted. Registers of short
    texts are mostly borrowed and far from independent: where both texts have at most LOWEST
    shingles, the distance of their counts per remainder, which no pair of fit similarity exceeds,
    takes their place, and where only one has, the least shingles alone decide.
    """
    spread = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), (F.col("size") / TILE).cast("int") + 1))
    wanted = members.select(F.col("doc_id").alias("wanted")).distinct()
    low = _lowest(rows.join(wanted, F.col("doc_id") == F.col("wanted"), "left_semi"), k)
    details = cut(sketches.select("doc_id", "registers").join(low, "doc_id"))
    held = members.select("band", "doc_id", "n", "component", spread.alias("tile")).join(details, "doc_id")
    tiles = cut(held.groupBy("band", "tile").agg(F.collect_list(F.struct("doc_id", "n", "component", "registers", "low")).alias("held")))
    # pairs of tiles are formed by name; each then gets its bodies by keys of its own
    x, y = (tiles.select("band", F.col("tile").alias(f"tile_{s}"), F.col("held").alias(f"held_{s}")) for s in "xy")
    met = cut(x.select("band", "tile_x").join(y.select("band", "tile_y"), "band").where("tile_x <= tile_y"))
    met = met.join(x, ["band", "tile_x"]).join(y, ["band", "tile_y"])
    # five standard deviations of the estimate below the threshold
    least = percent / 100 - 5 * (percent / 100 * (1 - percent / 100) / BUCKETS) ** 0.5

    def run(batches):
        for batch in batches:
            for band, same, x, y in zip(*(batch.column(i) for i in range(4))):
                band, same, x, y = band.as_py(), same.as_py(), x.as_py(), y.as_py()
                out = []
                one, two = (np.frombuffer(b"".join(r["registers"] for r in z), np.uint16).reshape(-1, BUCKETS) for z in (x, y))
                keys, others = _band_keys(one), _band_keys(two)
                lows = [np.frombuffer(r["low"], "<u4") for r in y]
                ids, n, comp = (np.array([r[c] for r in y]) for c in ("doc_id", "n", "component"))
                own_counts, counts = (_remainders([np.frombuffer(r["low"], "<u4") for r in z]) for z in (x, y))
                for i, r in enumerate(x):
                    near = (comp != r["component"]) & (100 * np.minimum(n, r["n"]) >= percent * np.maximum(n, r["n"]))
                    if same:
                        near &= ids > r["doc_id"]
                    at = np.flatnonzero(near)
                    long = np.minimum(n[at], r["n"]) > LOWEST
                    short = np.maximum(n[at], r["n"]) <= LOWEST
                    fit = ~long & ~short
                    fit[long] = similarity(two[at[long]], one[i]) >= least
                    apart = np.abs(counts[at[short]] - own_counts[i]).sum(1, dtype=np.int64)
                    fit[short] = (100 + percent) * apart <= (100 - percent) * (n[at[short]] + r["n"])
                    at = at[fit]
                    shared = others[at] == keys[i]
                    at = at[keys[i][shared.argmax(1)] == band]
                    mine = np.frombuffer(r["low"], "<u4")
                    out += [(min(r["doc_id"], int(ids[j])), max(r["doc_id"], int(ids[j]))) for j in at if _may_link(mine, lows[j], r["n"], int(n[j]), percent)]
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])

    return met.select("band", (F.col("tile_x") == F.col("tile_y")).alias("same"), "held_x", "held_y").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents whose k-word shingle sets have a Jaccard similarity >= percent / 100.

    1. Sketch every whole text; documents of equal sets form a class, its smallest id stands for it.
    2. Band the registers; in each band, every class meets the band's smallest class. Pairs of fit
       sizes are verified on full sets, and components are taken.
    3. Where a band still holds several components, its classes are compared with each other in
       tiles, by registers and then by their least shingles; likely pairs that were not verified
       yet are, and components are taken again. So no link is lost but by the sketches' chance.

    Result, a row per input row: doc_id, n_shingles, component_id, kept (doc_id = component_id).
    Texts without words (null, empty, blank) have no shingles and stand alone. Rows that share an
    id are judged by their own texts; where several stand for classes, their links count together. A null id is linked with
    nothing: null component, kept. Further columns are not read. An empty table gives an empty
    result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"))
    every = cut(_sketches(rows, k))
    full = every.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = cut(full.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep")))
    sketches = cut(full.join(classes.select("s1", "s2", "rep"), ["s1", "s2"]).where(F.col("doc_id") == F.col("rep")).dropDuplicates(["doc_id", "s1", "s2"]).select("doc_id", "n", "registers"))
    bands = _bands(sketches)
    hubs = cut(bands.groupBy("band").agg(F.min(F.struct("doc_id", "n")).alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1").select("band", F.col("hub.doc_id").alias("a"), F.col("hub.n").alias("n_a"), "size"))
    shared = cut(bands.join(hubs, "band"))
    pairs = cut(shared.where((F.col("a") != F.col("doc_id")) & _close("n", "n_a", percent)).select("a", F.col("doc_id").alias("b")).distinct())
    texts = rows.where(F.col("doc_id").isNotNull())
    links = cut(_verified(pairs, texts, k, percent))
    found = cut(components(links))
    labelled = shared.where("size > 2").select("band", "doc_id", "n", "size").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    labelled = cut(labelled)
    open_bands = cut(labelled.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("band"))
    more = _cross_pairs(labelled.join(open_bands, "band"), sketches, texts, k, percent).join(pairs, ["a", "b"], "left_anti")
    more = cut(more)
    if not more.isEmpty():
        links = cut(links.union(_verified(more, texts, k, percent)))
        found = cut(components(links))
    final = cut(classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("s1", "s2", "rep", F.coalesce("component", "rep").alias("component")))
    ids = every.select("doc_id", "n", F.when(F.col("n") > 0, F.col("s1")).otherwise(F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.lit("alone"))).alias("s1"), "s2")
    out = ids.join(final, ["s1", "s2"], "left").withColumn("component_id", F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))).otherwise(F.col("doc_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2 over all documents, with the contract's two-word shingles."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=2)
