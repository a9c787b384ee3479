"""From raw documents to packed training sequences, in five stages.

All stages take null ids and texts, empty and very long texts, repeated rows, empty tables and
further columns of any name; all but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lambi.llm.encoding import public_path
from lambi.llm.minhash import near_duplicates
from lambi.llm.mixing import mix_sources
from lambi.llm.packing import pack_documents
from lambi.llm.quality import repetition_coverage
from lambi.llm.shared import remove, scratch, shared_dir
from lambi.llm.substrings import remove_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the base rule or repetition coverage rejects.

    Each row is judged by its own text, whatever its id; null and empty texts go (they have fewer
    than 50 words). Repeated rows fare alike.
    """
    carry = tuple(c for c in docs.columns if c != "text")
    kept = repetition_coverage(docs, with_text=True, carry=carry).where("kept")
    return kept.select(*(F.col("text") if c == "text" else F.col("carried").getField(c).alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies (five-word shingles, similarity 0.8).

    The smallest id of a group stays. Of rows with the same id and text, null ids too, one stays;
    rows of one id with different texts stay if the group of one of them is kept by that id. Rows
    with a null id, and texts without words, are near copies of nothing.
    """
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeated.isEmpty():
        docs = docs.dropDuplicates(["doc_id", "text"])
    kept = near_duplicates(docs, k=5, percent=80).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    renamed = docs.select(*(F.col(c).alias(f"doc.{c}") for c in docs.columns))
    left = renamed.join(kept, F.col("`doc.doc_id`").eqNullSafe(F.col("kept_id")), "left_semi")
    return left.select(*(F.col(f"`doc.{c}`").alias(c) for c in docs.columns))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated 100-byte strings out of the texts; a document left without a word goes (so null
    and empty texts go). `n_chars`, where there is one, follows the new text; other columns stay."""
    carry = tuple(c for c in docs.columns if c not in ("text", "n_chars"))
    left = remove_repeats(docs, with_text=True, carry=carry).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long").alias("n_chars")}
    return left.select(*(new[c] if c in new else F.col("carried").getField(c).alias(c) for c in docs.columns))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat every row as often as its calibrated weight has it drawn, so that the tokens meet the
    targets in expectation; a row of no copies goes. Rows of one id share one draw; a null id is
    never drawn once more; a text without words has weight 1."""
    drawn = mix_sources(docs, carry=tuple(docs.columns))
    each = drawn.select("carried", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return each.select("carried.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the token ids of all documents into sequences of 2048: a row per piece, with its ids, its
    sequence and its place there. A null or empty text is one end id; repeated rows and null ids are
    documents of their own. Further columns end here."""
    return pack_documents(docs, public_path("word_bpe_49k.json"), with_ids=True)


STAGES = [("quality rules", quality_rules), ("near dedup", near_dedup), ("substring dedup", substring_dedup), ("mixing", mixing), ("packing", packing)]
#: Several stages have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again before the next.

    What a stage cuts is deleted when its result is written, and that when the next one's is; the
    last result stays in the shared folder.
    """
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        path = shared_dir(spark)
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if last is not None:
            remove(spark, last)
        last = path
    return docs
