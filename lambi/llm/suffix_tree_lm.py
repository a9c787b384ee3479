"""Scores by a probabilistic suffix tree over words (operator 7)."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lambi.llm.shared import LOWER, KeyFilter, cut, mix, range_hashes, signed, text_slices, word_spans

#: Occurrences of a context, and of a next symbol stored with it, in the training texts. Neither
#: depends on the size of the corpus.
LEAST_CONTEXT, LEAST_NEXT = 64, 8
DISCOUNT = 0.75
#: A context is kept if it saves so many bits in all, and so many an occurrence, over its suffix.
GAIN_BITS, DIVERGENCE = 64.0, 0.1
#: Most frequent words, contexts and entries that every task has at hand. The others are joined;
#: the bounds change the speed only.
HEAD_WORDS, HEAD_CONTEXTS, HEAD_ENTRIES = 300_000, 200_000, 800_000
#: Tokens whose counts meet in one group; contexts of more than SPREAD of them go to several groups.
BUCKET_TOKENS, SPREAD = 1_000_000, 250_000
END = np.int64(signed(mix(np.array([0x656E64], dtype=np.uint64)))[0])
#: Keys of contexts and of entries are told apart from words by these.
_CONTEXT, _ENTRY = np.int64(0x3C6EF372FE94F82B), np.int64(0x1F83D9ABFB41BD6B)


def _tokens(data: np.ndarray, offsets: np.ndarray):
    """Hash and row of each token: a row's words in order, then its end."""
    data = LOWER[data]
    begin, end, row = word_spans(data, offsets)
    n_rows = len(offsets) - 1
    at = np.arange(len(begin)) + row
    stops = np.bincount(row, minlength=n_rows).cumsum() + np.arange(n_rows)
    out = np.full(len(begin) + n_rows, END, dtype=np.int64)
    rows = np.empty(len(out), dtype=np.int64)
    out[at], rows[at] = signed(range_hashes(data, begin, end)), row
    rows[stops] = np.arange(n_rows)
    return out, rows


def _turn(level: int) -> int:
    return 13 * level % 61 + 1


def _join_grams(prefix: np.ndarray, suffix: np.ndarray, level: int) -> np.ndarray:
    """Hash of the run of level + 1 tokens that begins with one run of `level` and ends with another."""
    r = _turn(level)
    x = suffix.view(np.uint64)
    return prefix ^ ((x << np.uint64(r)) | (x >> np.uint64(64 - r))).view(np.int64)


def _gram(prefix: str, suffix: str, level: int) -> Column:
    """The same as a column."""
    r = _turn(level)
    return F.col(prefix).bitwiseXOR(F.shiftleft(suffix, r).bitwiseOR(F.shiftrightunsigned(suffix, 64 - r)))


def _steps(tokens: np.ndarray, rows: np.ndarray):
    """For level 1, 2, ...: places of tokens with so many tokens before them in their row, their
    contexts, and their own runs of `level` tokens."""
    grams, level = tokens, 1
    while True:
        at = np.flatnonzero(rows[level:] == rows[:-level]) + level if len(rows) > level else np.zeros(0, np.int64)
        if not len(at):
            return
        yield level, at, grams[at - 1], grams[at]
        longer = grams.copy()
        longer[at] = _join_grams(grams[at - 1], grams[at], level)
        grams, level = longer, level + 1


class _Table:
    """A hash table of 64-bit keys and doubles."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        size = 1 << max(4, int(len(keys) * 1.6).bit_length())
        self.mask = np.int64(size - 1)
        self.keys, self.values = np.zeros(size, dtype=np.int64), np.zeros(size)
        keys = np.where(keys == 0, 1, keys)
        left, slot = np.arange(len(keys)), keys & self.mask
        while len(left):
            free = np.flatnonzero(self.keys[slot] == 0)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.values[slot[put]] = keys[left[put]], values[left[put]]
            rest = np.ones(len(left), dtype=bool)
            rest[put] = False
            left, slot = left[rest], (slot[rest] + 1) & self.mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of keys, -1 where absent."""
        keys = np.where(keys == 0, 1, keys)
        slot = keys & self.mask
        held = self.keys[slot]
        out = np.where(held == keys, slot, -1)
        left = np.flatnonzero((held != keys) & (held != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            held = self.keys[slot[left]]
            hit = held == keys[left]
            out[left[hit]] = slot[left[hit]]
            left = left[~hit & (held != 0)]
        return out


def _summed(keys: list[np.ndarray], counts: list[np.ndarray], sort_by: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of several key columns, by one that tells them apart, and their summed counts."""
    order = np.argsort(sort_by)
    ranked = sort_by[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    return [k[order[first]] for k in keys], np.add.reduceat(counts[order], first)


def _count_words(docs: DataFrame) -> DataFrame:
    """Counts (k, n) of all tokens; a task adds up its own before they are shuffled."""

    def run(batches):
        held, size = [], 0

        def merged():
            (k,), n = _summed([np.concatenate([k for k, _ in held])], np.concatenate([n for _, n in held]), np.concatenate([k for k, _ in held]))
            return k, n

        def out(k, n):
            for lo in range(0, len(k), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(k[lo : lo + 100_000]), pa.array(n[lo : lo + 100_000])], names=["k", "n"])

        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                held.append(np.unique(_tokens(data, offsets)[0], return_counts=True))
                size += len(held[-1][0])
                if size > 3_000_000:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > 1_500_000:
                        yield from out(*held[0])
                        held, size = [], 0
        if size:
            yield from out(*merged())

    return docs.select("body").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))


def _count_entries(docs: DataFrame, level: int, sent, buckets: int, least_next: int) -> DataFrame:
    """Counts (c, s, n >= least_next) of contexts of `level` tokens with the run s of as many tokens
    that ends one further on, where both filters sent let them pass. The third thing sent says
    over how many groups a frequent context is spread.

    A task adds up its own and packs them by bucket, so that a row is shuffled per task and bucket.
    """
    kind = np.dtype([("c", "<i8"), ("s", "<i8")])

    def run(batches):
        contexts, nexts, spread = sent.value
        held, size = [], 0

        def merged():
            c, s, n = (np.concatenate([h[i] for h in held]) for i in range(3))
            (c, s), n = _summed([c, s], n, _join_grams(c, s, level))
            return c, s, n

        def out(c, s, n):
            at = spread.find(c)
            parts = np.where(at >= 0, spread.values[at], 1).astype(np.uint64)
            bucket = (mix(c.view(np.uint64) + mix(s.view(np.uint64)) % parts) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort((bucket << 40) | (c.view(np.uint64) >> np.uint64(24)).view(np.int64))  # equal contexts side by side
            cuts = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0))
            pairs = np.empty(len(order), dtype=kind)
            pairs["c"], pairs["s"], n = c[order], s[order], n[order]
            rows = [(int(bucket[order[lo]]), pairs[lo:hi].tobytes(), n[lo:hi].astype("<u4").tobytes()) for lo, hi in zip(cuts, np.append(cuts[1:], len(order)))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "pairs", "ns"])

        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                for k, _, c, s in _steps(*_tokens(data, offsets)):
                    if k < level:
                        continue
                    use = np.flatnonzero(nexts.has(s))
                    use = use[contexts.has(c[use])]
                    if len(use):
                        c, s = c[use], s[use]
                        (c, s), n = _summed([c, s], np.ones(len(c), dtype=np.int64), _join_grams(c, s, level))
                        held.append((c, s, n))
                        size += len(c)
                    break
                if size > 3_000_000:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > 1_500_000:
                        yield from out(*held[0])
                        held, size = [], 0
        if size:
            yield from out(*merged())

    def add(partial: pa.Table) -> pa.Table:
        pairs = np.frombuffer(b"".join(partial["pairs"].to_pylist()), dtype=kind)
        n = np.frombuffer(b"".join(partial["ns"].to_pylist()), dtype="<u4").astype(np.int64)
        c, s = pairs["c"].copy(), pairs["s"].copy()
        (c, s), n = _summed([c, s], n, _join_grams(c, s, level))
        often = n >= least_next
        return pa.table([pa.array(c[often]), pa.array(s[often]), pa.array(n[often])], names=["c", "s", "n"])

    packed = docs.select("body").mapInArrow(run, "bucket long, pairs binary, ns binary")
    return packed.groupBy("bucket").applyInArrow(add, "c long, s long, n long")


def _few(table: DataFrame) -> DataFrame:
    """The table, to be broadcast if it has HEAD_CONTEXTS rows at most."""
    return F.broadcast(table) if table.count() <= HEAD_CONTEXTS else table


def _fit(train: DataFrame, unigrams: DataFrame, total: int, floor: float, least_context: int, least_next: int, gain_bits: float, divergence: float) -> tuple[DataFrame, DataFrame] | None:
    """(contexts, entries) of the tree: c, total, spare share; gram, count, log10 of its probability
    over what the spare share gives. None without contexts."""
    contexts = unigrams.where((F.col("n") >= least_context) & (F.col("k") != F.lit(int(END)))).select(F.col("k").alias("c"), F.col("n").alias("total"))
    below = unigrams.where(F.col("n") >= least_next).select(F.col("k").alias("s"), ((F.col("n") + 0.5) / F.lit(floor)).alias("below"))
    buckets = max(32, total // BUCKET_TOKENS)
    kept_all, stored_all, level = [], [], 1
    while not contexts.isEmpty():
        wide = contexts.where(F.col("total") > SPREAD).orderBy(F.desc("total"), "c").limit(HEAD_CONTEXTS).toArrow()
        spread = _Table(wide["c"].to_numpy(), np.ceil(wide["total"].to_numpy() / SPREAD))
        sent = train.sparkSession.sparkContext.broadcast((KeyFilter(contexts, "c"), KeyFilter(below, "s"), spread))
        counted = _count_entries(train, level, sent, buckets, least_next)
        entries = cut(counted.join(_few(contexts), "c").join(below, "s").withColumn("share", (F.col("n") - DISCOUNT) / F.col("total")))
        sent.destroy()
        spare = entries.groupBy("c").agg((1 - F.sum("share")).alias("spare"), F.sum("n").alias("seen"))
        entries = cut(entries.join(_few(cut(spare)), "c").withColumn("p", F.col("share") + F.col("spare") * F.col("below")))
        gain = F.sum(F.col("n") * F.log2(F.col("p") / F.col("below"))) + (F.first("total") - F.first("seen")) * F.log2(F.first("spare"))
        tested = entries.groupBy("c").agg(gain.alias("gain"), F.first("total").alias("total"), F.first("spare").alias("spare"))
        kept = cut(tested.where((F.col("gain") >= gain_bits) & (F.col("gain") >= divergence * F.col("total"))).select("c", "total", "spare"))
        stored = cut(entries.join(_few(kept.select("c")), "c", "left_semi").select("c", "s", "n", "p", "below", _gram("c", "s", level).alias("gram"), (F.log10(F.col("p") / F.col("below")) - F.log10("spare")).alias("bonus")))
        kept_all.append(kept.select("c", "total", "spare"))
        stored_all.append(stored.select("gram", "n", "bonus"))
        contexts = cut(stored.where(F.col("n") >= least_context).join(kept.select(F.col("c").alias("s")), "s", "left_semi").select(F.col("gram").alias("c"), F.col("n").alias("total")))
        below = stored.select(F.col("gram").alias("s"), F.col("p").alias("below"))
        level += 1
    if not kept_all:
        return None
    return reduce(DataFrame.unionByName, kept_all), reduce(DataFrame.unionByName, stored_all)


def _most_frequent(table: DataFrame, count: str, bound: int) -> Column:
    """A condition that holds for the rows of highest `count`, at most `bound` of them."""
    step = F.floor(F.log2(count) * 8).cast("int")
    sizes = table.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("size")).orderBy(F.desc("step")).collect()
    least, used = None, 0
    for r in sizes:
        used += r["size"]
        if used > bound:
            break
        least = r["step"]
    return F.lit(False) if least is None else step >= least


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 1


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_context: int = LEAST_CONTEXT, least_next: int = LEAST_NEXT, gain_bits: float = GAIN_BITS, divergence: float = DIVERGENCE,
    head_words: int = HEAD_WORDS, head_contexts: int = HEAD_CONTEXTS, head_entries: int = HEAD_ENTRIES,
) -> DataFrame:
    """Train on the documents outside the held-out fifth, score all of them.

    Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end. The base is the
    unigram model (c + 0.5) / (N + 0.5 (V + 1)), the tree's root. Contexts are runs of words of any
    length with at least `least_context` occurrences whose suffix (without the first word) and prefix
    (without the last) are kept. A context stores the next symbols seen `least_next` times and gives
    them (count - DISCOUNT) / total, and all symbols the spared share times their probability in its
    suffix. It is kept if that saves `gain_bits` in all and `divergence` bits an occurrence over its
    suffix; the tree grows level by level until no context passes. Each token is scored at the
    longest kept suffix of its history, so each text's probabilities sum to one over its tokens.

    Nothing is bounded by the size of the corpus: words, contexts and entries are tables. The most
    frequent (`head_words`, `head_contexts`, `head_entries`) are broadcast, the others joined by shuffle; filters of
    fixed size keep most rows without a partner out of the joins. 64-bit hashes stand for words and
    runs of words.

    A null or empty text is its end token. A null id counts as an empty one for the fold. Repeated
    rows are each scored. Very long texts are single rows of a step. Other columns are not read. An
    empty table gives an empty result; without training rows, N = V = 0 holds for the base. A row
    is known by its place in its partition, so `docs` should come from files or a checkpoint, whose
    partitions are the same when an executor is lost.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"))
    train = rows.where(~held_out(F.col("doc_id")))
    unigrams = cut(_count_words(train))
    total, distinct = unigrams.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    floor = total + 0.5 * (distinct + 1)
    tree = _fit(train, unigrams, total, floor, least_context, least_next, gain_bits, divergence)

    word_value = F.log10((F.col("n") + 0.5) / F.lit(floor))
    near, far, filters, tail_filters = [], [], [], []

    def deal(rows: DataFrame, count: str, bound: int) -> None:
        often = _most_frequent(rows, count, bound)
        near.append(rows.where(often).select("k", "v"))
        far.append(rows.where(~often).select("k", "v"))

    deal(unigrams.select("k", "n", word_value.alias("v")), "n", head_words)
    if tree:
        contexts = cut(tree[0].select(F.col("c").bitwiseXOR(F.lit(int(_CONTEXT))).alias("k"), "total", F.log10("spare").alias("v")))
        deal(contexts, "total", head_contexts)
        deal(tree[1].select(F.col("gram").bitwiseXOR(F.lit(int(_ENTRY))).alias("k"), "n", F.col("bonus").alias("v")), "n", head_entries)
        filters, tail_filters = [KeyFilter(contexts)], [KeyFilter(x) for x in far[1:]]
    got = reduce(DataFrame.unionByName, near).toArrow()
    table = _Table(got["k"].to_numpy(), got["v"].to_numpy())
    del got
    sent = spark.sparkContext.broadcast((table, filters, tail_filters))
    del table

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"uid long, doc_id {kind}, h long, n long, known long, base double, score double, word boolean"
    types = [pa.int64(), None, pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()]
    names = ["uid", "doc_id", "h", "n", "known", "base", "score", "word"]

    def asked(keys, row):
        """Distinct (row, key) and how often each occurs."""
        order = np.lexsort((keys, row))
        k, r = keys[order], row[order]
        first = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (r[1:] != r[:-1]))) if len(order) else order
        return k[first], r[first], np.diff(np.append(first, len(order)))

    def run(batches):
        table, filters, tails = sent.value
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(2)):
                n_rows = hi - lo
                tokens, row = _tokens(data, offsets)
                at = table.find(tokens)
                near = at >= 0
                value = np.where(near, table.values[at], 0.0)
                base = np.bincount(row, weights=value, minlength=n_rows)
                score = base.copy()
                known, length = np.bincount(row[near], minlength=n_rows), np.bincount(row, minlength=n_rows)
                wanted = [(tokens[~near], row[~near], True)]
                alive = np.ones(len(tokens), dtype=bool)
                for level, places, c, s in _steps(tokens, row) if filters else ():
                    use = np.flatnonzero(alive[places])
                    key = c[use] ^ _CONTEXT
                    maybe = filters[0].has(key)
                    use, key = use[maybe], key[maybe]
                    alive[:] = False
                    if not len(use):
                        break
                    at = table.find(key)
                    far = (at < 0) & tails[0].has(key)
                    alive[places[use[(at >= 0) | far]]] = True
                    wanted.append((key[far], row[places[use[far]]], False))
                    kept = (at >= 0) | far
                    use, at = use[kept], at[kept]
                    entry = _join_grams(c[use], s[use], level) ^ _ENTRY
                    bonus = table.find(entry)
                    gained = np.where(at >= 0, table.values[at], 0.0) + np.where(bonus >= 0, table.values[bonus], 0.0)
                    score += np.bincount(row[places[use]], weights=gained, minlength=n_rows)
                    far = (bonus < 0) & tails[1].has(entry)
                    wanted.append((entry[far], row[places[use[far]]], False))
                uid = batch.column(0).slice(lo, n_rows)
                spread = signed(mix(uid.to_numpy().view(np.uint64) + np.uint64(1)))
                yield pa.RecordBatch.from_arrays([uid, batch.column(1).slice(lo, n_rows), *(pa.array(x, t) for x, t in zip((spread, length, known, base, score), types[2:7])), pa.nulls(n_rows, pa.bool_())], names=names)
                for is_word in (True, False):
                    keys, of = (np.concatenate([w[i] for w in wanted if w[2] == is_word] or [np.zeros(0, np.int64)]) for i in (0, 1))
                    keys, of, times = asked(keys, of)
                    for a in range(0, len(keys), 200_000):
                        part = slice(a, a + 200_000)
                        none = [pa.nulls(len(keys[part]), t or batch.column(1).type) for t in types]
                        yield pa.RecordBatch.from_arrays([uid.take(pa.array(of[part])), none[1], pa.array(keys[part]), pa.array(times[part]), none[4], none[5], none[6], pa.array(np.full(len(keys[part]), is_word))], names=names)

    keyed = rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "body")
    parts = keyed.mapInArrow(run, schema)
    values = reduce(DataFrame.unionByName, far)
    joined = parts.join(values.withColumnRenamed("k", "h"), "h", "left")
    is_doc = F.col("known").isNotNull()
    unseen = float(np.log10(0.5 / floor))
    word_sum = F.sum(F.when(F.col("word"), F.col("n") * F.coalesce("v", F.lit(unseen))))
    tree_sum = F.sum(F.when(~F.col("word"), F.col("n") * F.coalesce("v", F.lit(0.0))))
    out = joined.groupBy("uid").agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"), F.sum(F.when(is_doc, F.col("n"))).alias("n_tokens"),
        F.sum(F.when(is_doc, F.col("known")).when(F.col("word") & F.col("v").isNotNull(), F.col("n"))).alias("n_known"),
        F.coalesce(word_sum, F.lit(0.0)).alias("rare"), F.coalesce(tree_sum, F.lit(0.0)).alias("far"), F.sum("base").alias("base"), F.sum("score").alias("score"),
    )
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("rare")).alias("base_score"), (F.col("score") + F.col("rare") + F.col("far")).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7 over all documents."""
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
