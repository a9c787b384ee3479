"""The pipeline keeps an executor's memory within bounds: small slices, one Python worker a task."""

import re

import numpy as np
import pyarrow as pa

from lambi.llm import shared, substrings
from lambi.llm.encoding import encoder, public_path
from lambi.llm.packing import _decoded, pack_documents


def test_packing_with_ids_runs_one_python_step_a_task(spark):
    rows = [(i, "word " * (1 + 37 * i % 900)) for i in range(300)] + [(None, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = pack_documents(docs, public_path("word_bpe_49k.json"), with_ids=True)
    assert len(re.findall("MapInArrow", out._jdf.queryExecution().executedPlan().toString())) == 1
    enc, got = encoder(public_path("word_bpe_49k.json")), out.collect()
    want = sorted((i or -1, [*enc._ids(t or ""), 0]) for i, t in rows)
    assert sorted((r["doc_id"] or -1, r["ids"]) for r in got) == want and all(len(r["ids"]) == r["length"] for r in got)


def test_ids_of_either_width_and_of_a_part_of_a_column():
    for kind in ("<u2", "<u4"):
        ids = [[1], [40000, 5], [65535] * 3, [9]]
        column = pa.array([np.array(x, kind).tobytes() for x in ids], pa.binary())
        assert _decoded(column.slice(1, 2), np.array([2, 3])).to_pylist() == ids[1:3]


def test_slices_hold_half_a_megabyte():
    column = pa.array(["x" * 100_000] * 50)
    assert max(len(data) for _, _, data, _ in shared.text_slices(column)) <= 1 << 19 and substrings.SORT_BYTES <= 1 << 19
