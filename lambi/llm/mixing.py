"""Mixing of sources to target weights by iterative proportional fitting (operator 6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lambi.llm.shared import cut

#: Dimension -> either a power (target share in proportion to its tokens ** power) or shares by value.
TARGETS = {"source": 0.5, "lang": {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}, "topic": 0.8}
#: Share given to a value that a table of shares doesn't name.
OTHER_SHARE = 0.05
ROUNDS = 12
SEED = "mix"
#: Cells up to this many are broadcast to the documents; more are joined by shuffle.
BROADCAST_CELLS = 100_000
WORDS = r"[^\x20\x09-\x0D]+"


def topic_of(text: Column) -> Column:
    """Default topic: the kind of text, by what occurs anywhere in it."""
    text = F.coalesce(text, F.lit(""))
    return F.when(text.contains("|"), "table").when(text.rlike("[Ll]icen[sc]e"), "legal").when(text.contains("@"), "contact").otherwise("prose")


def _raw_share(name: str, target) -> Column:
    if isinstance(target, dict):
        out = F.lit(OTHER_SHARE)
        for value, share in sorted(target.items()):
            out = F.when(F.col(name) == value, share).otherwise(out)
        return out
    return F.pow(F.sum("tokens").over(Window.partitionBy(name)), F.lit(float(target)))


def rake(cells: DataFrame, targets: dict, rounds: int = ROUNDS, together: int = BROADCAST_CELLS) -> DataFrame:
    """Fit weights of cells (dimensions, tokens) to the target share of every dimension's values.

    Adds ``weight``, the factor on the cell's tokens, and ``residual``, the largest relative distance
    of a marginal from its target after the last round (the same for all cells). Each round scales
    the fitted tokens to one marginal after the other. `cells` holds one row per combination of
    values: up to `together` of them are fitted by windows in one partition, more by grouped sums
    and joins, which gives the same weights.
    """
    cells = cut(cells.where(F.col("tokens") > 0).withColumn("tokens", F.col("tokens").cast("double")).withColumn("fitted", F.col("tokens")))
    return _rake_together(cells, targets, rounds) if cells.count() <= together else _rake_apart(cells, targets, rounds)


def _rake_together(cells: DataFrame, targets: dict, rounds: int) -> DataFrame:
    every = Window.partitionBy()
    df = cells.coalesce(1)
    for name, target in targets.items():
        df = df.withColumn("raw", _raw_share(name, target))
        mine = F.sum("tokens").over(Window.partitionBy(name))
        df = df.withColumn("part", F.col("tokens") / mine * F.col("raw"))
        df = df.withColumn(f"target_{name}", F.sum("tokens").over(every) * F.col("raw") / F.sum("part").over(every))
    for _ in range(rounds):
        for name in targets:
            df = df.withColumn("fitted", F.col("fitted") * F.col(f"target_{name}") / F.sum("fitted").over(Window.partitionBy(name)))
    off = [F.abs(F.sum("fitted").over(Window.partitionBy(name)) / F.col(f"target_{name}") - 1) for name in targets]
    df = df.withColumn("off", F.greatest(*off) if len(off) > 1 else off[0])
    return df.select(*targets, (F.col("fitted") / F.col("tokens")).alias("weight"), F.max("off").over(every).alias("residual"))


def _rake_apart(cells: DataFrame, targets: dict, rounds: int) -> DataFrame:
    total = cells.agg(F.sum("tokens")).first()[0]
    goals = {}
    for name, target in targets.items():
        sums = cells.groupBy(name).agg(F.sum("tokens").alias("sum"))
        share = _raw_share(name, target) if isinstance(target, dict) else F.pow("sum", F.lit(float(target)))
        shares = cut(sums.select(name, share.alias("raw")))
        goals[name] = cut(shares.select(name, (F.col("raw") * F.lit(total / shares.agg(F.sum("raw")).first()[0])).alias("target")))
    df = cells
    for _ in range(rounds):
        for name, goal in goals.items():
            factor = df.groupBy(name).agg(F.sum("fitted").alias("sum")).join(goal, name).select(name, (F.col("target") / F.col("sum")).alias("factor"))
            df = cut(df.join(factor, name).withColumn("fitted", F.col("fitted") * F.col("factor")).drop("factor"))
    off = [df.groupBy(name).agg(F.sum("fitted").alias("sum")).join(goal, name).agg(F.max(F.abs(F.col("sum") / F.col("target") - 1))).first()[0] for name, goal in goals.items()]
    return df.select(*targets, (F.col("fitted") / F.col("tokens")).alias("weight"), F.lit(max(off)).alias("residual"))


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) that follows from the key alone."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix_sources(docs: DataFrame, targets: dict | None = None, topic: Column | None = None, rounds: int = ROUNDS, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Weights, probabilities and the drawn sample of every document.

    Tokens (words ``[^\\x20\\x09-\\x0D]+`` of whole texts) are summed by source, language and topic;
    `rake` fits those sums to the targets. A document's ``weight`` is its cell's factor w: it is
    used floor(w) times and once more with probability w - floor(w) (``probability``), drawn from
    a hash of its id; ``copies`` is the outcome. In expectation the sampled tokens meet all
    marginals. ``kept`` says whether a sample without repeats holds the document (copies > 0).

    ``residual`` is the largest relative distance of a marginal from its target that the rounds
    left. `topic` is any column, such as a classifier's output; by default it is the kind of text.

    Null dimensions count as the empty value. Texts without words (null or empty) have no tokens to
    weigh: weight 1, residual null if no other row has their cell. A very long text counts whole. A
    null id draws 1 (never the extra copy). Rows with one id, or repeated, share one draw.
    Only the id, text, source and lang columns are read, and those in `carry`, which come back as a
    struct `carried` of the same input row. An empty table gives an empty result.
    """
    targets = TARGETS if targets is None else targets
    kind = topic_of(F.col(text_col)) if topic is None else topic
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("long")
    dimensions = [F.coalesce(c, F.lit("")).alias(name) for name, c in (("source", F.col("source")), ("lang", F.col("lang")), ("topic", kind))]
    rows = docs.select(F.col(id_col).alias("doc_id"), *dimensions, words.alias("n_tokens"), *([F.struct(*carry).alias("carried")] if carry else []))
    rows = cut(rows)
    cells = cut(rake(rows.groupBy(*targets).agg(F.sum("n_tokens").alias("tokens")), targets, rounds))
    small = cells.count() <= BROADCAST_CELLS
    joined = rows.join(F.broadcast(cells) if small else cells, list(targets), "left")
    weight = F.coalesce("weight", F.lit(1.0))
    extra = weight - F.floor(weight)
    drawn = F.coalesce(uniform(F.col("doc_id"), seed), F.lit(1.0)) < extra
    copies = (F.floor(weight) + drawn.cast("int")).cast("long")
    out = joined.select(
        "doc_id", "source", "lang", "topic", "n_tokens", F.round(weight, 6).alias("weight"), F.round(extra, 6).alias("probability"), copies.alias("copies"), F.round("residual", 6).alias("residual"),
        *(["carried"] if carry else []),
    )
    return out.withColumn("kept", F.col("copies") > 0)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6 over all documents."""
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    steps = [f"""r AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
        CASE WHEN contains(coalesce(text, ''), '|') THEN 'table' WHEN regexp_matches(coalesce(text, ''), '[Ll]icen[sc]e') THEN 'legal'
             WHEN contains(coalesce(text, ''), '@') THEN 'contact' ELSE 'prose' END AS topic,
        coalesce(len(regexp_extract_all(text, '{WORDS}')), 0)::BIGINT AS n_tokens FROM documents)""",
        "c AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM r GROUP BY ALL HAVING sum(n_tokens) > 0)",
        "f0 AS (SELECT *, tokens AS fitted FROM c)"]
    last = "f0"
    for name, target in TARGETS.items():
        if isinstance(target, dict):
            raw = f"CASE {name} " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in target.items()) + f" ELSE {OTHER_SHARE}::DOUBLE END"
        else:
            raw = f"pow(sum(tokens) OVER (PARTITION BY {name}), {target}::DOUBLE)"
        steps.append(f"a_{name} AS (SELECT *, {raw} AS raw_{name}, tokens / sum(tokens) OVER (PARTITION BY {name}) * {raw} AS part_{name} FROM {last})")
        steps.append(f"t_{name} AS (SELECT *, sum(tokens) OVER () * raw_{name} / sum(part_{name}) OVER () AS target_{name} FROM a_{name})")
        last = f"t_{name}"
    for i in range(ROUNDS):
        for name in TARGETS:
            steps.append(f"f_{i}_{name} AS (SELECT * EXCLUDE fitted, fitted * target_{name} / sum(fitted) OVER (PARTITION BY {name}) AS fitted FROM {last})")
            last = f"f_{i}_{name}"
    return "WITH " + ",\n".join(steps) + f"""
    , y AS (SELECT *, greatest({', '.join(f"abs(sum(fitted) OVER (PARTITION BY {k}) / target_{k} - 1)" for k in TARGETS)}) AS off FROM {last}), z AS (SELECT *, max(off) OVER () AS residual FROM y),
    w AS (SELECT r.*, residual, coalesce(fitted / tokens, 1.0::DOUBLE) AS w, coalesce(('0x' || substr(md5('{SEED}|' || doc_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE, 1.0::DOUBLE) AS u
            FROM r LEFT JOIN z USING (source, lang, topic))
    SELECT doc_id, source, lang, topic, n_tokens, round(w, 6) AS weight, round(w - floor(w), 6) AS probability,
           (floor(w) + (u < w - floor(w))::INT)::BIGINT AS copies, round(residual, 6) AS residual, floor(w) + (u < w - floor(w))::INT > 0 AS kept FROM w"""


ORACLE = _sql()
