import random

from lambi.llm.minhash import near_duplicates


def test_links_of_short_texts_that_meet_beside_their_hubs(spark):
    """4 of 5 shingles in common, and smaller ids that share the bands of both but are near neither."""
    rng = random.Random(7)
    rows, linked = [], set()
    for i in range(0, 3200, 4):
        w = ["".join(rng.choices("abcdefghijklmnop", k=8)) for _ in range(6)]
        rows += [(i, " ".join(w[:4])), (i + 1, " ".join(w[1:5])), (i + 2, " ".join(w[:5])), (i + 3, " ".join(w))]
        linked.add(i + 2)
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2).collect()
    assert {(r["doc_id"], r["component_id"]) for r in out} == {(i, i - 1 if i - 1 in linked else i) for i, _ in rows}
