import random
import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lambi.llm import idstore, minhash, packing, suffix_tree_lm
from lambi.llm.encoding import encoder, public_path
from lambi.llm.minhash import near_duplicates
from lambi.llm.quality import repetition_coverage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(None, "no id"), (900, None), (901, ""), (902, " \n\t"), (903, "one"), (904, "one"), (905, "É" * 50_000), (905, "É" * 50_000)]


def frame(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 1, "k") for i, t in rows], "doc_id long, text string, key string, n int, body string").repartition(3)


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    base = [[word() for _ in range(rng.randint(60, 200))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = list(rng.choice(base)) if i % 2 else [word() for _ in range(rng.randint(1, 150))]
        for _ in range(rng.randint(0, 6) if i % 2 else 0):
            words[rng.randrange(len(words))] = word()
        rows.append((i, " ".join(words)))
    return rows


def test_quality_counts(spark):
    rows = corpus() + ODD + [(950, "same line here\nsame line here\n\nother\nsame line here"), (951, "a b c " * 40), (952, "# $ a|b <x> " * 30)]
    got = {(r["doc_id"], r["n_words"]): r for r in repetition_coverage(frame(spark, rows)).collect()}
    for i, t in rows:
        w = WORD.findall(t or "")
        seen, dup = set(), 0
        for line in (t or "").split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        grams = Counter(zip(w, w[1:], w[2:]))
        hit = {k for j in range(len(w) - 2) if grams[tuple(w[j : j + 3])] > 1 for k in range(j, j + 3)}
        r = got[i, len(w)]
        assert (r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(hit)), i
        assert r["base_failed"] == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
        assert not (r["kept"] and r["base_failed"])
    assert repetition_coverage(frame(spark, rows)).count() == len(rows)
    assert repetition_coverage(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize(("k", "tile"), [(2, minhash.TILE), (5, minhash.TILE), (2, 3), (5, 2)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, k, tile):
    """Also with bands of many tiles."""
    monkeypatch.setattr(minhash, "TILE", tile)
    rows = [r for r in corpus(k) + ODD if r[0] is not None]
    sets = {}
    for i, t in rows:
        w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in WORD.findall(t or "")]
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    out = near_duplicates(frame(spark, rows), k=k).collect()
    assert len(out) == len(rows)
    assert {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in out} == {(i, len(s), top(i), top(i) == i) for i, s in sets.items()}
    assert near_duplicates(frame(spark, rows).limit(0), k=k).count() == 0


def test_encoder_equals_library():
    texts = ["", "a\xa0 b", "a\x1cb ..", "don't, it's.) 12,3a² x_y", "<|endoftext|> x", "A\n\nB \n C", "É" * 300, " the,cat", *(t for _, t in corpus())]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        enc = encoder(public_path(name))
        want = Tokenizer.from_file(public_path(name)).encode_batch(texts, add_special_tokens=False)
        assert [np.frombuffer(x, enc.kind).tolist() for x in enc.encode(texts)] == [x.ids for x in want]


def test_id_store_round_trip(spark, monkeypatch):
    monkeypatch.setattr(idstore, "SHARD_BYTES", 4000)
    rows = corpus() + ODD
    path = idstore.write_ids(frame(spark, rows), public_path("byte_bpe_50k.json"))
    fresh = Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    start = 0
    got = sorted(idstore.read_ids(spark, path, with_ids=True).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    for r, (i, t) in zip(got, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))):
        want = np.array([*fresh.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        assert r["ids"] == want.tolist() and (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)
    found = Counter((r["doc_id"], tuple(r["ids"])) for r in idstore.lookup(spark, path, [3, 902, 905, 5000]).collect())
    assert found == Counter((r["doc_id"], tuple(r["ids"])) for r in got if r["doc_id"] in (3, 902, 905))
    assert idstore.read_ids(spark, idstore.write_ids(frame(spark, rows).limit(0), public_path("byte_bpe_50k.json"))).count() == 0


def test_many_rows_of_one_id_spread_over_partitions(spark):
    rows = [(None, f"text {i}") for i in range(400)] + [(7, f"more {i}") for i in range(400)] + [(i, "x") for i in range(8, 40)]
    path = idstore.write_ids(frame(spark, rows), public_path("byte_bpe_50k.json"), partitions=6)
    sizes = [r["n"] for r in spark.read.parquet(path).groupBy("part").agg(F.sum("n_docs").alias("n")).collect()]
    assert len(sizes) >= 5 and max(sizes) < 300
    got = sorted(idstore.read_ids(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None] * 400 + [7] * 400 + list(range(8, 40))
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:])) and got[0]["start"] == 0
    assert idstore.lookup(spark, path, [7]).count() == 400


def test_index_is_minimal_and_perfect():
    for n in (1, 2, 5, 1000):
        keys = np.random.default_rng(n).choice(10**12, n, replace=False).astype(np.int64)
        seeds, slots = idstore.build_index(keys)
        assert sorted(slots) == list(range(n))


def check_plan(counts, size):
    runs = packing.plan(counts, size)
    used, bins = Counter(), {}
    for length, first, n, sequence, places, offset in runs.tolist():
        assert used[length] == first
        used[length] += n
        for r in range(n):
            bins.setdefault(sequence + r // places, []).append((offset + r % places * length, length))
    assert used == Counter(counts)
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def test_packing_plans():
    rng = random.Random(2)
    for _ in range(30):
        counts = Counter(rng.randint(1, 64) for _ in range(rng.randint(1, 400)))
        n = check_plan(dict(counts), 64)
        least = max(sum(k * v for k, v in counts.items()) / 64, sum(v for k, v in counts.items() if k > 32))
        assert least <= n <= 1.1 * least + 2
    assert check_plan({60: 5, 4: 5}, 64) == 5 and check_plan({50: 2, 10: 2, 4: 2}, 64) == 2 and check_plan({40: 3, 12: 3, 8: 3, 4: 3}, 64) == 3 and check_plan({}, 64) == 0


def test_packed_documents(spark):
    rows = corpus() + ODD
    out = packing.pack_documents(frame(spark, rows), public_path("word_bpe_49k.json"), size=256).collect()
    fresh = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    want = Counter()
    for i, t in rows:
        ids = np.array([*fresh.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want.update((i, p, a, len(ids[a : a + 256]), zlib.crc32(ids[a : a + 256].tobytes())) for p, a in enumerate(range(0, len(ids), 256)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack_documents(frame(spark, rows).limit(0), public_path("word_bpe_49k.json")).count() == 0


def test_suffix_tree_scores(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(x for _ in range(40) for x in rng.choice((["the", "cat", "sat"], ["a", "dog", "ran"], [f"w{rng.randint(0, 400)}"])))) for i in range(150)] + ODD
    out = suffix_tree_lm.score_documents(frame(spark, rows), gain_bits=1.0).collect()
    assert len(out) == len(rows)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    toks = [(i, [*WORD.findall((t or "").translate(low)), None]) for i, t in rows]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    c = Counter(x for i, t in toks if not held(i) for x in t)
    total = sum(c.values())
    base = Counter((i, len(t), sum(c[x] > 0 for x in t), round(sum(log10((c[x] + 0.5) / (total + 0.5 * (len(c) + 1))) for x in t), 6)) for i, t in toks)
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in out) == base
    assert all(r["train_tokens"] == total and r["held_out"] == held(r["doc_id"]) for r in out)
    fresh = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in fresh) > sum(r["base_score"] for r in fresh) + 10
    assert suffix_tree_lm.score_documents(frame(spark, rows).limit(0)).count() == 0
