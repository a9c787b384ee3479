"""Keyed quota windows, in batch and as a stream."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUT = "key string, id long, ts timestamp, ok boolean, remaining int, reset timestamp, retry_after int"


def _answer(count: int, limit: int, now: pd.Timestamp, reset: pd.Timestamp):
    ok = count <= limit
    return ok, max(0, limit - count), reset, 0 if ok else math.ceil((reset - now).total_seconds())


def quota_batch(events: DataFrame, limit: int, seconds: int) -> DataFrame:
    """Answer to each event (key, id, ts), events of a key in order of (ts, id).

    A window opens at a key's first event after the last window ended; every event counts, also
    refused ones. Rows come sorted by key and time and are streamed through a task, which keeps
    only the open window of the key it is at; a key's events pass one task, as each answer
    depends on the one before.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, reset, count = None, None, 0
        for pdf in batches:
            rows = []
            for k, i, ts in zip(pdf["key"], pdf["id"], pdf["ts"]):
                if k != key or reset is None or ts >= reset:
                    key, reset, count = k, ts + pd.Timedelta(seconds=seconds), 0
                count += 1
                rows.append((k, i, ts, *_answer(count, limit, ts, reset)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in OUT.split(", ")])

    ordered = events.select(F.col("key").cast("string").alias("key"), F.col("id").cast("long").alias("id"), F.col("ts").cast("timestamp").alias("ts")).repartition("key").sortWithinPartitions("key", "ts", "id")
    return ordered.mapInPandas(run, OUT)


class _Quota(StatefulProcessor):
    def __init__(self, limit: int, seconds: int):
        self.limit, self.seconds = limit, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", "reset timestamp, count int")

    def handleInputRows(self, key, rows, timerValues):
        """A key's rows of one micro-batch, put in order of (ts, id) first: they come in any order."""
        held = self.window.get() if self.window.exists() else None
        reset, count = (pd.Timestamp(held[0]), held[1]) if held else (None, 0)
        out = []
        for i, ts in pd.concat([pdf[["id", "ts"]] for pdf in rows]).sort_values(["ts", "id"]).itertuples(index=False):
            if reset is None or ts >= reset:
                reset, count = ts + pd.Timedelta(seconds=self.seconds), 0
            count += 1
            out.append((key[0], i, ts, *_answer(count, self.limit, ts, reset)))
        self.window.update((reset.to_pydatetime(), count))
        self.handle.registerTimer(int(reset.timestamp() * 1000))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self.window.get() if self.window.exists() else None
        if held and pd.Timestamp(held[0]).timestamp() * 1000 <= expiredTimerInfo.getExpiryTimeInMs():
            self.window.clear()
        return iter([])

    def close(self) -> None:
        pass


@contextmanager
def rocksdb(spark: SparkSession):
    """Streams started inside keep their state in the RocksDB store, which keyed state needs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, old)


def quota_stream(events: DataFrame, limit: int, seconds: int, watermark: str = "10 minutes") -> DataFrame:
    """The same over a stream: keyed state, dropped by an event-time timer when a window ends.

    Events later than the watermark are dropped, as they can't be answered in order any more; a
    repeated event counts again.
    """
    keyed = events.withWatermark("ts", watermark).groupBy("key")
    return keyed.transformWithStateInPandas(_Quota(limit, seconds), OUT, "Append", "EventTime")


def curate_stream(clips: DataFrame, rules, key, watermark_column: str, delay: str = "1 hour") -> DataFrame:
    """Rows that pass all rules, the first of each content key within the watermark."""
    from lambi.operators.rules import first_failing

    passed = clips.withColumn("drop_reason", first_failing(rules)).where("drop_reason is null").drop("drop_reason")
    return passed.withColumn("content_key", key).withWatermark(watermark_column, delay).dropDuplicatesWithinWatermark(["content_key"])


def write_signups(stream: DataFrame, path: str, checkpoint: str):
    """Append valid sign-ups with the time of their arrival as JSON lines."""
    from lambi.operators.rules import signup

    rows = signup(stream).where("valid").drop("valid").withColumn("received", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"))
    return rows.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
