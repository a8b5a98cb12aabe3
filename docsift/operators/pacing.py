"""Rate and retry control as data: failure streaks, write-offs, and token-bucket admission."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsift.session import ship

WRITE_OFF_AFTER = 8


def failure_streaks(events: DataFrame, failed: Column, by: str = "host", order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """events with streak, the number of failures in a row up to and with each event of its host."""
    w = Window.partitionBy(by).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    marked = events.withColumn("_bad", failed.cast("int")).withColumn("_island", F.sum(1 - F.col("_bad")).over(upto))
    inner = Window.partitionBy(by, "_island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return marked.withColumn("streak", F.sum("_bad").over(inner)).drop("_bad", "_island")


def write_offs(events: DataFrame, failed: Column, by: str = "host", order: tuple[str, ...] = ("ts",), limit: int = WRITE_OFF_AFTER) -> DataFrame:
    """Per host: the longest streak, and whether it reached the limit."""
    runs = failure_streaks(events, failed, by, order)
    return runs.groupBy(by).agg(F.max("streak").cast("long").alias("longest"), (F.max("streak") >= limit).alias("written_off"))


class Bucket:
    """Token bucket of one host: capacity max(1, rate), refilled by time, one token a request."""

    def __init__(self, rate: float):
        self.rate = max(rate, 0.001)
        self.capacity = self.tokens = max(1.0, self.rate)
        self.updated: float | None = None

    def acquire(self, now: float) -> float:
        """The time at which a request that arrives now may go; arrivals are in order."""
        at = now if self.updated is None else max(now, self.updated)
        if self.updated is not None:
            self.tokens = min(self.capacity, self.tokens + (at - self.updated) * self.rate)
        if self.tokens < 1:
            at += (1 - self.tokens) / self.rate
            self.tokens = 1.0
        self.tokens -= 1
        self.updated = at
        return at

    def slow_to(self, seconds: float) -> None:
        """At most one request in so many seconds from now on; never faster than before."""
        if seconds > 0 and 1 / seconds < self.rate:
            self.rate = max(1 / seconds, 0.001)
            self.capacity, self.tokens = 1.0, min(self.tokens, 1.0)


def admit(requests: DataFrame, rate: float, by: str = "host", arrival: str = "arrival_s", key: str = "request_id", slow: str | None = None) -> DataFrame:
    """requests (by, key, arrival) with admitted_s, host by host in order of arrival.

    A host's requests wait for one another, so one host is one task's work; slow names a
    column with the seconds a host is to be slowed to after a request (0: unchanged).
    """
    ship(requests.sparkSession)
    columns = [by, key, arrival, *([slow] if slow else [])]
    kinds = {f.name: f.dataType.simpleString() for f in requests.schema}

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        bucket, out = Bucket(rate), []
        rows = rows.sort_values([arrival, key])
        for k, now in enumerate(rows[arrival]):
            out.append(bucket.acquire(float(now)))
            if slow and rows[slow].iloc[k] > 0:
                bucket.slow_to(float(rows[slow].iloc[k]))
        return pd.DataFrame({by: rows[by].values, key: rows[key].values, arrival: rows[arrival].values, "admitted_s": out})

    return requests.select(*columns).groupBy(by).applyInPandas(run, f"{by} {kinds[by]}, {key} {kinds[key]}, {arrival} {kinds[arrival]}, admitted_s double")
