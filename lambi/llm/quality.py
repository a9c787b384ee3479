"""Repetition coverage of whole texts (operator 4)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lambi.llm.shared import mix, per_row, range_hashes, text_slices, word_spans

#: n-gram length in words -> largest share of word characters that n-grams found at least
#: twice in the same text may cover.
NGRAM_LIMITS = {5: 0.30, 8: 0.25, 12: 0.20}
#: Largest share of word characters in lines that repeat an earlier line of the text.
LINE_LIMIT = 0.30
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _twice(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur at least twice, and which equal an earlier one."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.zeros(len(keys) + 1, dtype=bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    twice, later = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    twice[order] = same[:-1] | same[1:]
    later[order] = same[:-1]
    return twice, later


def _covered(hashes: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Which words lie in an n-word window found at least twice in their row."""
    marks = np.zeros(len(hashes) + 1, dtype=np.int64)
    if len(hashes) >= n:
        m = len(hashes) - n + 1
        rolled = np.zeros(m, dtype=np.uint64)
        for i in range(n):
            rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + hashes[i : i + m]
        whole = np.flatnonzero(row[:m] == row[n - 1 :])
        keys = mix(rolled[whole] ^ mix(row[whole].astype(np.uint64) + np.uint64(n << 40)))
        hit = whole[_twice(keys)[0]]
        np.add.at(marks, hit, 1)
        np.add.at(marks, hit + n, -1)
    return np.cumsum(marks)[:-1] > 0


def _measure(data: np.ndarray, offsets: np.ndarray, lengths: list[int]) -> dict[str, np.ndarray]:
    n = len(offsets) - 1
    begin, end, row = word_spans(data, offsets)
    hashes = range_hashes(data, begin, end)
    lead = (data & 0xC0) != 0x80
    points = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(lead, out=points[1:])
    chars = points[end] - points[begin]
    total = lambda w: np.bincount(row, weights=w, minlength=n).astype(np.int64)
    out = {"n_words": np.bincount(row, minlength=n), "word_chars": total(chars), "n_symbols": per_row(_SYMBOL[data], offsets)}
    breaks = np.flatnonzero(data == 10)
    at = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    at = at[at < len(data)]
    stop = np.minimum(np.append(at[1:], len(data)), len(data))
    of = np.searchsorted(offsets, at, side="right") - 1
    stop = np.minimum(stop, offsets[of + 1])
    stop = stop - ((stop > at) & (data[np.maximum(stop - 1, 0)] == 10))
    word_at = np.searchsorted(at, begin, side="right") - 1
    full = np.zeros(len(at), dtype=bool)
    full[word_at] = True
    keys = mix(range_hashes(data, at, stop) ^ mix(of.astype(np.uint64)))
    later = np.zeros(len(at), dtype=bool)
    later[full] = _twice(keys[full])[1]
    out["n_dup_lines"] = np.bincount(of[later], minlength=n)
    out["dup_line_chars"] = total(chars * later[word_at])
    out["n_repeat_words"] = total(_covered(hashes, row, 3))
    for k in lengths:
        out[f"dup_{k}gram_chars"] = total(chars * _covered(hashes, row, k))
    return out


def repetition_coverage(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram_limits: dict[int, float] | None = None, line_limit: float = LINE_LIMIT, min_words: int = 50, with_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Measure each row's text and judge it; one result row per input row, no shuffle.

    Words are ``[^\\x20\\x09-\\x0D]+``. Counts are those of the base rule; ``dup_<n>gram_chars``
    are the characters of words inside n-word windows found at least twice in the text (all
    occurrences), ``dup_line_chars`` those in lines equal to an earlier line. Rolling 64-bit
    hashes stand for words, windows and lines. ``kept`` is false where the base rule fails (fewer
    than `min_words` words, or over half of the words in repeated 3-word windows) or where a
    covered share is above its limit.

    A null or empty text has no words and fails the base rule. Null ids and repeated rows pass
    through row by row; a very long text is one numpy step. Only the id and text columns are read,
    so further columns can't clash, and those in `carry`, which come back as a struct `carried` of
    the same input row; `with_text` gives the text back as well. An empty table gives an empty result.
    """
    limits = NGRAM_LIMITS if ngram_limits is None else ngram_limits
    lengths = sorted(limits)
    names = [*COUNTS, "dup_line_chars", *(f"dup_{k}gram_chars" for k in lengths)]
    source = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("body"), *([F.struct(*carry).alias("carried")] if carry else []))
    schema = StructType([source.schema["key"], *StructType.fromDDL(", ".join(f"{x} long" for x in names) + ", text string" * with_text).fields, *source.schema.fields[2:]])

    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(1)):
                got = _measure(data, offsets, lengths)
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], *(pa.array(got[x].astype(np.int64)) for x in names), *(c.slice(lo, hi - lo) for c in batch.columns[1 if with_text else 2 :])], names=schema.names)

    out = source.mapInArrow(run, schema)
    share = lambda c: F.col(c) / F.greatest(F.col("word_chars"), F.lit(1))
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    fine = share("dup_line_chars") <= line_limit
    for k in lengths:
        fine &= share(f"dup_{k}gram_chars") <= limits[k]
    return out.withColumnRenamed("key", id_col).withColumn("base_failed", base).withColumn("kept", ~base & fine)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4 over all documents."""
    return repetition_coverage(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    word = r"[^\x20\x09-\x0D]+"
    lengths = sorted(NGRAM_LIMITS)
    covered = ", ".join(f"sum(length(ws[pos])) FILTER (n = {k}) AS c{k}" for k in lengths)
    columns = ", ".join(f"coalesce(c{k}, 0)::BIGINT AS dup_{k}gram_chars" for k in lengths)
    fine = " AND ".join([f"dup_line_chars / greatest(word_chars, 1) <= {LINE_LIMIT}", *(f"dup_{k}gram_chars / greatest(word_chars, 1) <= {NGRAM_LIMITS[k]}" for k in lengths)])
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{word}') AS ws FROM documents),
    l AS (SELECT rid, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS k FROM d),
    ll AS (SELECT rid, list_sum(list_transform(regexp_extract_all(line, '{word}'), lambda x: length(x))) AS chars, row_number() OVER (PARTITION BY rid, line ORDER BY k) AS nth FROM l WHERE regexp_matches(line, '{word}')),
    dl AS (SELECT rid, count(*) AS n_dup_lines, sum(chars)::BIGINT AS dup_line_chars FROM ll WHERE nth > 1 GROUP BY rid),
    g AS (SELECT rid, n, i, md5(array_to_string(list_slice(ws, i, i + n - 1), chr(1))) AS gram FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (VALUES (3), {", ".join(f"({k})" for k in lengths)}) v(n) WHERE len(ws) >= n)),
    r AS (SELECT rid, n, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, n, gram) > 1),
    c AS (SELECT DISTINCT rid, n, unnest(range(i, i + n)) AS pos FROM r),
    v AS (SELECT rid, count(*) FILTER (n = 3) AS n_repeat_words, {covered} FROM c JOIN d USING (rid) GROUP BY rid),
    m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
          coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(dup_line_chars, 0) AS dup_line_chars, {columns} FROM d LEFT JOIN dl USING (rid) LEFT JOIN v USING (rid)),
    b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
    SELECT *, NOT base_failed AND {fine} AS kept FROM b"""


ORACLE = _sql()
