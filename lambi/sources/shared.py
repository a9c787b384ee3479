"""Tables kept in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir; where that is unset, under a temporary one if Spark
    runs in one process, else an error."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="lambi-")
    return f"{top.rstrip('/')}/lambi-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """The rows written as Parquet and read back: ends the lineage, survives lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
