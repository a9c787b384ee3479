import random
import re
import zlib
from collections import Counter, defaultdict
from math import log2, log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from lambi.llm import suffix_tree_lm as lm
from lambi.llm.shared import KeyFilter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*WORD.findall((text or "").translate(LOW)), None]


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1


def brute_tree(train, least_context, least_next, gain_bits, divergence):
    """Root and {context: (spare, {next: probability})} with plain dictionaries."""
    c = Counter(x for t in train for x in t)
    total, floor = sum(c.values()), sum(c.values()) + 0.5 * (len(c) + 1)
    root = lambda x: (c[x] + 0.5) / floor
    kept: dict = {}

    def p(ctx, x):
        while ctx:
            if ctx in kept:
                spare, near = kept[ctx]
                return near[x] if x in near else spare * p(ctx[1:], x)
            ctx = ctx[1:]
        return root(x)

    candidates = {(x,): n for x, n in c.items() if n >= least_context and x is not None}
    level = 1
    while candidates:
        seen = defaultdict(Counter)
        for t in train:
            for i in range(level, len(t)):
                if tuple(t[i - level : i]) in candidates:
                    seen[tuple(t[i - level : i])][t[i]] += 1
        new, grams = {}, {}
        for ctx, n in candidates.items():
            stored = {x: m for x, m in seen[ctx].items() if m >= least_next}
            if not stored:
                continue
            spare = 1 - sum((m - lm.DISCOUNT) / n for m in stored.values())
            prob = {x: (m - lm.DISCOUNT) / n + spare * p(ctx[1:], x) for x, m in stored.items()}
            gain = sum(m * log2(prob[x] / p(ctx[1:], x)) for x, m in stored.items()) + (n - sum(stored.values())) * log2(spare)
            if gain >= gain_bits and gain >= divergence * n:
                new[ctx] = (spare, prob)
                grams |= {(*ctx, x): m for x, m in stored.items()}
        kept |= new
        candidates = {g: m for g, m in grams.items() if m >= least_context and g[1:] in new}
        level += 1
    return c, total, root, kept, p


@pytest.mark.parametrize("heads", [{}, {"head_words": 30, "head_contexts": 12, "head_entries": 25}, {"head_words": 0, "head_contexts": 0, "head_entries": 0}])
def test_scores_equal_a_plain_tree(spark, heads):
    rng = random.Random(4)
    phrases = [["the", "Cat", "sat", "on", "the", "mat"], ["a", "dog", "ran", "on", "a", "road"], ["to", "be", "or", "not", "to", "be"], ["on", "the", "road", "to", "a", "mat"]]
    text = lambda: " ".join(x for _ in range(rng.randint(0, 25)) for x in (rng.choice(phrases) if rng.random() < 0.7 else [f"w{rng.randint(0, 60)}"]))
    rows = [(i, text()) for i in range(160)] + [(None, "the cat"), (900, None), (901, ""), (902, " \n"), (903, "the cat " * 9000), (7, "the cat sat"), (7, "the cat sat")]
    rule = {"least_context": 6, "least_next": 2, "gain_bits": 3.0, "divergence": 0.02}
    c, total, _, kept, p = brute_tree([tokens(t) for i, t in rows if not held(i)], **rule)
    assert max(map(len, kept)) >= 3 and len(kept) > 40
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("c", F.lit("c")).withColumn("n", F.lit(1))
    out = sorted(lm.score_documents(df, **rule, **heads).collect(), key=lambda r: (str(r["doc_id"]), r["n_tokens"], r["score"]))
    want = []
    for i, t in rows:
        w = tokens(t)
        score = 0.0
        for j, x in enumerate(w):
            lo = j
            while lo > 0 and tuple(w[lo - 1 : j]) in kept:
                lo -= 1
            score += log10(p(tuple(w[lo:j]), x))
        want.append((i, len(w), sum(c[x] > 0 for x in w), score))
    want.sort(key=lambda r: (str(r[0]), r[1], r[3]))
    assert [(r["doc_id"], r["n_tokens"], r["n_known"]) for r in out] == [x[:3] for x in want]
    assert np.allclose([r["score"] for r in out], [x[3] for x in want], rtol=1e-9, atol=1e-9)
    assert all(r["train_tokens"] == total for r in out)


def test_probabilities_of_a_context_sum_to_one():
    rng = random.Random(1)
    train = [[*(rng.choice("aab" if rng.random() < 0.5 else "abcd") for _ in range(30)), None] for _ in range(40)]
    c, _, root, kept, p = brute_tree(train, 5, 2, 1.0, 0.0)
    rest = 1 - sum(root(x) for x in c)
    for ctx in kept:
        unseen = rest
        for k in range(len(ctx)):
            unseen *= kept[ctx[k:]][0] if ctx[k:] in kept else 1
        assert abs(sum(p(ctx, x) for x in c) + unseen - 1) < 1e-9


def test_filter_and_table_hold_their_keys(spark):
    rng = np.random.default_rng(2)
    keys = np.unique(np.concatenate([rng.integers(-(2**63), 2**63, 5000), [0, -1, 1]]))
    table = lm._Table(keys, np.arange(len(keys), dtype=float))
    ok = keys[(keys != 1) & (keys != 0)]
    assert (table.values[table.find(ok)] == np.flatnonzero((keys != 1) & (keys != 0))).all()
    other = np.setdiff1d(rng.integers(-(2**63), 2**63, 5000), keys)
    assert (table.find(other) == -1).all()
    f = KeyFilter(spark.createDataFrame([(int(k),) for k in keys], "k long"))
    assert f.has(keys).all() and f.has(other).mean() < 0.01
    pair = spark.createDataFrame([(int(a), int(b)) for a, b in zip(keys[:50], keys[50:100])], "a long, b long")
    for level in (1, 2, 7):
        assert sorted(r[0] for r in pair.select(lm._gram("a", "b", level)).collect()) == sorted(lm._join_grams(keys[:50], keys[50:100], level).tolist())
