"""Spelling variants grouped under their common form by asymmetric q-chunks (operator 11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lambi.llm.shared import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words up to this length are verified by Spark's own distance.
SHORT = 64
LETTER = r"[A-Za-zÀ-ÿ]"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def noisy_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7, noise: int | None = 31) -> DataFrame:
    """Every run of letters of at least `min_length` (column `word`), A-Z lower-cased; where `noise`
    divides the crc32 h of ``<id>:<run>``, the run without its code point h % length."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(LETTER + "{%d,}" % min_length), F.lit(0))).alias("run"))
    runs = runs.select("id", lower_ascii(F.col("run")).alias("run"))
    if noise is None:
        return runs.select(F.col("run").alias("word"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % noise == 0, less).otherwise(F.col("run")).alias("word")).where(F.length("word") >= min_length)


def _bounds(length: Column) -> list[Column]:
    """Where the halves of a word, its two chunks, and their halves begin, and the end."""
    middle = F.floor(length / 2).cast("int")
    return [F.lit(0), F.floor(middle / 2).cast("int"), middle, middle + F.floor((length - middle) / 2).cast("int"), length]


def _around(word: str, length: Column, shift: Column, k: int) -> tuple[Column, Column]:
    """A word without its k-th quarter, as the length of the first word places it: what lies before
    at its place, what lies behind `shift` later."""
    b = _bounds(length)
    return F.substring(word, F.lit(1), b[k]), F.substring(word, b[k + 1] + shift + 1, F.length(word))


def _keys(word: str, length: Column, shift: int) -> list[Column]:
    return [F.struct(F.lit(k).alias("kind"), F.lit(shift).alias("shift"), F.xxhash64(F.lit(k), length, *_around(word, length, F.lit(shift), k)).alias("key")) for k in range(4)]


def _one_edit(x: str, y: str) -> Column:
    """Whether y is one edit from x, being as long or one longer. Spark's distance takes the square of
    the length even under a threshold, so long words are compared behind their first difference."""
    differ = F.zip_with(F.split(x, ""), F.split(y, ""), lambda a, b: ~a.eqNullSafe(b))
    at = F.array_position(differ, True).cast("int")
    rest = lambda w, i: F.substring(w, i, F.length(w))
    behind = F.when(F.length(x) == F.length(y), rest(x, at + 1) == rest(y, at + 1)).otherwise(rest(x, at) == rest(y, at + 1))
    return F.when(F.length(x) <= SHORT, F.levenshtein(x, y, 1) == 1).otherwise(behind)


def near_pairs(words: DataFrame) -> DataFrame:
    """All pairs (x, y, nx, ny) of distinct words of at least four code points, each pair once, that
    differ by one inserted, deleted or replaced code point; x is the shorter (of equal ones the
    smaller). `words` has each word once, with its count n.

    The shorter word gives two disjoint chunks, its halves; one edit leaves one of them whole, and
    in the other half, again, one of its two parts. So its keys are three of its quarters. The other
    word gives the grams at the same places, for a partner as long or one shorter; what
    lies behind the edit is moved by the difference of lengths, the only shift of at most one that
    can match. Words that share a key are verified. Of the keys that a pair shares the first counts.
    """
    x = words.select(F.col("word").alias("x"), F.col("n").alias("nx"), F.explode(F.array(*_keys("word", F.length("word"), 0))).alias("a")).select("x", "nx", "a.kind", "a.key")
    grams = _keys("word", F.length("word"), 0) + _keys("word", F.length("word") - 1, 1)
    y = words.select(F.col("word").alias("y"), F.col("n").alias("ny"), F.explode(F.array(*grams)).alias("a")).select("y", "ny", "a.kind", "a.shift", "a.key")
    size, shift = F.length("x"), F.length("y") - F.length("x")
    same = []
    for k in range(3):
        (ax, bx), (ay, by) = _around("x", size, F.lit(0), k), _around("y", size, shift, k)
        same.append((ax == ay) & (bx == by))
    first = F.when(same[0], 0).when(same[1], 1).when(same[2], 2).otherwise(3)
    met = x.join(y, ["key", "kind"]).where((F.col("shift") == shift) & ((shift == 1) | (F.col("x") < F.col("y"))))
    return met.where(_one_edit("x", "y")).where(F.col("kind") == first).select("x", "y", "nx", "ny")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7, min_count: int = 2, ratio: int = 10, noise: int | None = 31) -> DataFrame:
    """Words of the texts and the more common word that each is a variant of.

    Words are runs of letters of at least `min_length` code points that occur `min_count` times (n)
    or more. Two are near if they differ by one code point. The form of a word is its near word of
    largest n (ties: the smallest), if that is `ratio` times the word's n; its root is where the forms
    lead. Columns: word, form, root, n, n_near, form_n.

    Null and empty texts have no words. A null id counts as an empty one. Repeated rows count each.
    Words of any length are compared whole. Only the two columns are read, so others can't clash.
    An empty table gives an empty result.
    """
    found = noisy_words(docs, id_col, text_col, min_length, noise)
    words = cut(found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))
    pairs = near_pairs(words)
    both = F.explode(F.array(F.struct(F.col("x").alias("word"), F.col("y").alias("near"), F.col("ny").alias("m")), F.struct(F.col("y").alias("word"), F.col("x").alias("near"), F.col("nx").alias("m"))))
    best = pairs.select(both.alias("p")).groupBy("p.word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("p.m"), F.col("p.near"))).alias("best"))
    best = best.select("word", "n_near", (-F.col("best.col1")).alias("m"), F.col("best.near").alias("near"))
    is_form = F.col("m") >= ratio * F.col("n")
    formed = cut(words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("m")).alias("form_n")))
    roots = formed.where("form is not null").select("word", F.col("form").alias("root"))
    steps, most = 1, formed.agg(F.max("form_n")).first()[0] or 0
    while most >= min_count * ratio ** (steps + 1):  # a chain of so many forms can be
        steps *= 2
        further = roots.select(F.col("word").alias("_at"), F.col("root").alias("_on"))
        roots = cut(roots.join(further, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_on", "root").alias("root")))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11 over all documents."""
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: The crc32 table by its rule, and crc32 of a list of bytes; for DuckDB, which lacks it.
CRC_TABLE = "SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b::BIGINT)) AS crc_table"


def crc_sql(text: str) -> str:
    """crc32 of the UTF-8 bytes of a non-empty text, beside a relation with `crc_table`."""
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substring(hex(encode({text})), (2 * i + 1)::BIGINT, 2))::BIGINT)"
    return f"xor(list_reduce({octets}, lambda c, b: xor(crc_table[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295)"


ORACLE = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{LOWER}') AS run FROM documents),
hashed AS (SELECT *, {crc_sql("concat(doc_id, ':', run)")} AS h FROM (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 7 GROUP BY ALL), crc),
noisy AS (SELECT k, CASE WHEN h % 31 = 0 THEN concat(substring(run, 1, h % length(run)), substring(run, h % length(run) + 2)) ELSE run END AS word FROM hashed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM noisy WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
cuts AS (SELECT word, n, i, concat(substring(word, 1, i - 1), substring(word, i + 1)) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
         UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
         UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(m) AS m, arg_min(other, (-m, encode(other))) AS other FROM near GROUP BY word),
formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN other END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS place FROM formed UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON c.place = f.word WHERE f.form IS NOT NULL)
SELECT f.word, form, place AS root, n, n_near, form_n FROM formed f JOIN chain c ON f.word = c.word WHERE NOT EXISTS (SELECT 1 FROM formed g WHERE g.word = c.place AND g.form IS NOT NULL)"""
