"""Streaming twins: exactly-once rows, host failure state, the event log's tail, and windows over events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from docsift.functions.urls import normalise_url
from docsift.operators.pacing import WRITE_OFF_AFTER
from docsift.session import ship


def new_rows_sink(path: str, key: str = "url_key"):
    """A foreachBatch function that appends each key once, whatever is replayed: within the batch by order, against the table by an anti join."""

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates([key])
        try:
            known = spark.read.parquet(path).select(key)
            fresh = fresh.join(known, key, "left_anti")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        fresh.write.mode("append").parquet(path)

    return write


def first_within_watermark(stream: DataFrame, url_col: str = "url", ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """The first event of each canonical URL within the watermark."""
    return stream.withColumn("url_key", normalise_url(F.col(url_col))).withWatermark(ts, delay).dropDuplicatesWithinWatermark(["url_key"])


def host_failures(stream: DataFrame, failed: Column, by: str = "host", limit: int = WRITE_OFF_AFTER) -> DataFrame:
    """(host, streak, written_off) after each batch: failures in a row, kept as state per host. Needs a column seq for order."""
    ship(stream.sparkSession)

    def update(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        streak, off = state.get if state.exists else (0, False)
        for rows in batches:
            for bad in rows.sort_values("seq")["bad"]:
                streak = streak + 1 if bad else 0
                off = off or streak >= limit
        state.update((streak, off))
        yield pd.DataFrame({by: [key[0]], "streak": [streak], "written_off": [off]})

    rows = stream.select(F.col(by), F.col("seq"), failed.cast("boolean").alias("bad"))
    kind = dict(stream.dtypes)[by]
    return rows.groupBy(by).applyInPandasWithState(update, f"{by} {kind}, streak int, written_off boolean", "streak int, written_off boolean", "update", GroupStateTimeout.NoTimeout)


def event_tail(spark: SparkSession, folder: str) -> DataFrame:
    """The event log as a stream."""
    return spark.readStream.schema("ts timestamp, lvl string, event string, run_id string").json(folder)


def windowed_counts(events: DataFrame, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Tumbling counts by type, for batch or stream (an addition of this engine)."""
    marked = events.withWatermark("ts", delay) if events.isStreaming else events
    return marked.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def session_counts(events: DataFrame, gap: str = "30 minutes", by: str = "user_id") -> DataFrame:
    """Sessions per key by inactivity (an addition of this engine)."""
    marked = events.withWatermark("ts", gap) if events.isStreaming else events
    return marked.groupBy(by, F.session_window("ts", gap).alias("s")).agg(F.count(F.lit(1)).alias("n")).select(by, F.col("s.start").alias("start"), F.col("s.end").alias("stop"), "n")
