"""Scans, column detection, loose files and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from lambi.operators.running import running

# Names by which columns are recognised, first match first.
AUDIO = ["audio", "wav", "speech", "audio_filepath", "file", "path", "sound"]
TEXT = ["text", "transcription", "transcript", "sentence", "normalized_text", "target", "label", "caption", "content"]
SPEAKER = ["speaker_id", "speaker", "client_id", "spk_id", "spk", "session_id"]
PREDICTIONS = ["pred_text", "pred", "prediction", "transcript", "hypothesis"]
AUDIO_SUFFIXES = (".wav", ".mp3", ".flac", ".ogg", ".m4a", ".opus")


def pick_column(columns: list[str], candidates: list[str], explicit: str | None = None, required: bool = True) -> str | None:
    """The explicit name (exact) or the first candidate present, whatever its case."""
    if explicit is not None:
        if explicit not in columns:
            raise ValueError(f"no column {explicit!r} among {columns}")
        return explicit
    lower = {c.lower(): c for c in reversed(columns)}
    found = next((lower[c] for c in candidates if c in lower), None)
    if found is None and required:
        raise ValueError(f"none of {candidates} among {columns}")
    return found


def read_columnar(spark: SparkSession, path: str, text: str | None = None, audio: str | None = None, speaker: str | None = None, limit: int | None = None, need_audio: bool = True) -> DataFrame:
    """(file, idx, audio, raw_text, speaker) of a Parquet source; only those columns are read. `idx`
    counts on over the files of the source, by path; the rows of earlier files are counted from footers."""
    df = spark.read.parquet(path)
    t, a, s = pick_column(df.columns, TEXT, text), pick_column(df.columns, AUDIO, audio, need_audio), pick_column(df.columns, SPEAKER, speaker, False)
    who = (F.col(s) if s else F.lit(None)).cast("string").alias("speaker")
    files = df.groupBy(F.col("_metadata.file_path").alias("_f")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    df = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    df = df.join(F.broadcast(files.select("_f", before.alias("_before"))), F.col("_file") == F.col("_f"))
    out = df.select(F.col("_file").alias("file"), (F.col("_before") + F.col("_row")).alias("idx"), *([F.col(a).alias("audio")] if a else []), F.col(t).alias("raw_text"), who)
    return out if limit is None else out.limit(limit)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over all cores where the input has fewer files or parts than that (a row group is read by
    one task, so the parts into which a large file is split may be empty but for one); other inputs as
    they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if min(len(df.inputFiles()), df.rdd.getNumPartitions()) < cores else df


def is_loose(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds audio files and no Parquet; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.lower("path").alias("p"))
    flags = files.agg(F.max(F.col("p").endswith(".parquet").cast("int")), F.max(reduce(lambda a, b: a | b, (F.col("p").endswith(x) for x in AUDIO_SUFFIXES)).cast("int"))).first()
    return not flags[0] and bool(flags[1])


def read_loose(spark: SparkSession, path: str, metadata: str, limit: int | None = None) -> DataFrame:
    """Rows of a .csv or .jsonl table with the file of the same base name (of repeats the last
    path); rows without a file go."""
    meta = spark.read.option("header", True).csv(metadata) if metadata.endswith(".csv") else spark.read.json(metadata)
    name = pick_column(meta.columns, ["file_name", "filename", "file", "path", "audio", "audio_filepath"])
    t, s = pick_column(meta.columns, TEXT), pick_column(meta.columns, SPEAKER, None, False)
    base = lambda c: F.element_at(F.split(c, "/"), -1)
    rows = meta.select(F.monotonically_increasing_id().alias("idx"), base(F.col(name)).alias("base"), F.col(t).alias("raw_text"), (F.col(s) if s else F.lit(None).cast("string")).alias("speaker"))
    rows = rows if limit is None else rows.orderBy("idx").limit(limit)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(reduce(lambda a, b: a | b, (F.lower("path").endswith(x) for x in AUDIO_SUFFIXES)))
    last = files.groupBy(base(F.col("path")).alias("base")).agg(F.max("path").alias("path"))
    return rows.join(last, "base").join(files.select("path", F.col("content").alias("audio")), "path").select("idx", "path", "audio", "raw_text", "speaker")


def slug(repo: str, config: str | None = None) -> str:
    return "__".join([repo.replace("/", "__"), *([config] if config else [])])


def union_sources(sources: list[tuple[DataFrame, str, bool, float]]) -> DataFrame:
    """Union of (rows, name, synthetic, weight), with those and the order of sources as columns."""
    tagged = [df.withColumns({"source": F.lit(n), "synthetic": F.lit(s), "weight": F.lit(float(w)), "source_ord": F.lit(i)}) for i, (df, n, s, w) in enumerate(sources)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def block_sample(df: DataFrame, block: str, order: str, n: int, most_blocks: int = 5) -> DataFrame:
    """About n rows: evenly spaced blocks, and in each every k-th row, up to n in all."""
    blocks = df.groupBy(block).agg(F.count(F.lit(1)).alias("rows"))
    numbered = running(blocks, [block]).withColumnRenamed("number", "b")
    last = F.col("size") - 1
    k = F.least(F.lit(most_blocks).cast("long"), F.col("size"))
    wanted = F.transform(F.sequence(F.lit(0).cast("long"), k - 1), lambda i: F.bround(i * last / F.greatest(k - 1, F.lit(1))).cast("long"))
    step = F.greatest(F.lit(1), F.floor(F.col("rows") / F.greatest(F.lit(1), F.floor(n / k))))
    chosen = numbered.where(F.array_contains(wanted, F.col("b"))).select(F.col(block).alias("_block"), "b", step.alias("step"))
    rows = df.join(chosen, F.col(block) == F.col("_block")).drop("_block").withColumn("rn", F.row_number().over(Window.partitionBy(block).orderBy(order)))
    taken = rows.where((F.col("rn") - 1) % F.col("step") == 0)
    return taken.orderBy("b", "rn").limit(n).drop("b", "step", "rn")


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Predictions as JSON lines or one JSON array, told apart by the first character that is not
    blank. Each row takes the first prediction column whose key it has, null as its value may be."""
    first = spark.read.text(path).where(F.trim("value") != "").limit(1).first()
    whole = first is not None and first[0].lstrip().startswith("[")
    schema = spark.read.option("multiLine", whole).json(path).schema
    names = [c for c in PREDICTIONS if c in schema.names]
    if not names:
        raise ValueError(f"none of {PREDICTIONS} among {schema.names}")
    lines = spark.read.text(path, wholetext=whole).where(F.trim("value") != "")
    fields, keys = ArrayType(schema) if whole else schema, "map<string,string>"
    both = lines.select(F.from_json("value", fields).alias("r"), F.from_json("value", f"array<{keys}>" if whole else keys).alias("m"))
    if whole:
        both = both.select(F.explode(F.arrays_zip("r", "m")).alias("z")).select("z.r", "z.m")
    chosen = F.lit(None)
    for c in reversed(names):
        chosen = F.when(F.map_contains_key("m", c), F.col("r").getField(c)).otherwise(chosen)
    return both.select("r.*", chosen.alias("_chosen")).drop("pred_text").withColumnRenamed("_chosen", "pred_text")


def footer_counts(spark: SparkSession, sources: dict[str, str]) -> DataFrame:
    """(name, n): rows of each Parquet source by its file footers, without a column read; null for a
    source that can't be read. Counts are pushed down to the reader in a session of its own."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    each = []
    for name, path in sources.items():
        try:
            each.append(own.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n"))
        except AnalysisException:
            each.append(own.createDataFrame([(name, None)], "name string, n long"))
    return reduce(DataFrame.unionByName, each)


def write_reports(blocks: dict[str, DataFrame], path: str) -> None:
    """The tables of a report, each as JSON lines in a folder of its name."""
    for name, df in blocks.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


def read_report(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.json(f"{path}/{name}")


def write_manifest(df: DataFrame, path: str) -> None:
    """JSON lines, one folder a split; columns that begin with an underscore stay out. Splits that are
    there already are replaced, other splits stay."""
    rows = df.select(*(c for c in df.columns if not c.startswith("_")))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("split").json(path)


def write_pipe_manifest(df: DataFrame, path: str) -> None:
    """Lines of path|phonemes|speaker index."""
    df.select(F.concat_ws("|", "path", "phonemes", F.col("speaker_index").cast("string")).alias("value")).write.text(path)
