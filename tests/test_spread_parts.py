"""Files of one row group that are split into many parts."""

from pyspark.sql import functions as F

from lambi.sources.tables import spread


def test_a_row_group_is_dealt_over_all_cores(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.range(20000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("text")).coalesce(1).write.parquet(path)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in kept:
            spark.conf.set(k, "64k")
        df = spark.read.parquet(path)
        assert df.rdd.getNumPartitions() > 4
        rows = spread(df).groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in rows) == 20000 and len(rows) == 8 and max(r["count"] for r in rows) < 5000
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
