"""Operator 12 against brute force."""

import hashlib
import random
import re

from lambi.llm.decontaminate import find_contamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain(docs, items):
    out = []
    for i, text in docs:
        ws, hit, found = words(text), set(), set()
        for item, said in items:
            bs = words(said)
            k = min(10, len(bs))
            grams = {tuple(bs[j : j + k]) for j in range(len(bs) - k + 1)} if k and item is not None else set()
            for j in range(len(ws) - k + 1):
                if tuple(ws[j : j + k]) in grams:
                    hit |= set(range(j, j + k))
                    found.add(str(item))
        out.append((i, len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def run(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, window string, key int")
    b = spark.createDataFrame([(i, t, "y", 2) for i, t in items], "item_id long, text string, doc_id string, n int")
    return sorted((tuple(r) for r in find_contamination(d, b).collect()), key=repr)


def test_like_brute_force(spark):
    rng = random.Random(11)
    vocabulary = ["the", "of", "été", "Ünï", "a1", "z", "word", "x9x", "ß", "naïve"]
    said = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, said(rng.randint(8, 30))) for i in range(25)] + [(90, "the"), (91, "z word"), (92, "a1 of the z"), (93, "..."), (94, None), (95, ""), (None, "of of")]
    items += [(7, said(12)), items[3], (96, " ".join(["z"] * 14))]
    docs = []
    for i in range(80):
        parts = [said(rng.randint(0, 25))]
        for _ in range(rng.choice([0, 1, 2])):
            of = rng.choice(items)[1] or ""
            ws = re.split(r"[\s,]+", of)
            lo = rng.randint(0, max(0, len(ws) - 9))
            parts += [rng.choice([" ", ", ", "\n--"]).join(ws[lo : lo + rng.randint(8, 20)]).upper() if rng.random() < 0.3 else ", ".join(ws[lo:]), said(rng.randint(0, 9))]
        docs.append((i, rng.choice([" ", "-", ".\n"]).join(parts)))
    docs += [(100, None), (101, ""), (None, docs[4][1]), (None, docs[5][1]), docs[6], docs[6], (6, docs[7][1]), (102, "z " * 40)]
    got = run(spark, docs, items)
    assert got == plain(docs, items) and sum(r[5] for r in got) > 30


def test_nine_words_are_not_ten(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [(1, item.replace("five", "FIVE").replace(" ", "; ")), (2, item.replace(" two ", " 2 ").replace(" eleven", "")), (3, item[4:]), (4, "x " * 50_000 + item + " y" * 50_000)]
    assert [(r[0], r[2]) for r in run(spark, docs, [(5, item)])] == [(1, 11), (2, 0), (3, 10), (4, 11)]


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, [(1, "a b")], []) == plain([(1, "a b")], [])
