"""Fetching as a table: a polite HTTP client, a batch data source for it, and replay from stored responses."""

from __future__ import annotations

import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.functions import vocab
from docsift.functions.urls import host, normalise_url
from docsift.operators.pacing import WRITE_OFF_AFTER, Bucket
from docsift.session import ship

RESPONSE = "url string, final_url string, status int, headers map<string,string>, content binary, elapsed_s double, error string, attempts int, from_cache boolean, truncated boolean"


def open_url(url: str, method: str, headers: dict[str, str], timeout: float, max_bytes: int) -> tuple[int, str, dict[str, str], bytes, bool]:
    """One request: status, final URL, lower-cased headers, body up to max_bytes, and whether it was cut."""
    request = urllib.request.Request(url, method=method, headers=headers)
    try:
        with urllib.request.urlopen(request, timeout=timeout) as r:
            body = r.read(max_bytes + 1)
            return r.status, r.geturl(), {k.lower(): v for k, v in r.headers.items()}, body[:max_bytes], len(body) > max_bytes
    except urllib.error.HTTPError as e:
        body = e.read(max_bytes + 1)
        return e.code, e.geturl() or url, {k.lower(): v for k, v in e.headers.items()}, body[:max_bytes], len(body) > max_bytes


class Client:
    """Retries, backoff, Retry-After, pacing per host, write-off of hosts that keep failing, and a cache."""

    def __init__(self, rate: float = 1.0, retries: int = 2, base: float = 1.0, strategy: str = "exponential", timeout: float = 30.0, max_bytes: int = 40 << 20, user_agent: str = "docsift/0.1", opener: Callable = open_url, clock=time.monotonic, sleep=time.sleep, seed: int | None = None):
        self.rate, self.retries, self.base, self.strategy, self.timeout, self.max_bytes = rate, retries, base, strategy, timeout, max_bytes
        self.agent, self.opener, self.clock, self.sleep = user_agent, opener, clock, sleep
        self.random = random.Random(seed)
        self.buckets: dict[str, Bucket] = {}
        self.failures: dict[str, int] = {}
        self.cache: dict[str, dict] = {}

    def delay(self, attempt: int) -> float:
        seconds = self.base if self.strategy == "fixed" else self.base * 2 ** max(0, attempt - 1)
        return min(seconds, 60.0) * (1 + self.random.random() * 0.25)

    @staticmethod
    def retry_after(headers: dict[str, str]) -> float:
        try:
            return min(120.0, max(0.0, float(headers.get("retry-after", "").strip() or 0)))
        except ValueError:
            return 0.0

    def get(self, url: str, name: str, method: str = "GET") -> dict:
        if (kept := self.cache.get(url)) is not None and method == "GET":
            return {**kept, "from_cache": True}
        if self.failures.get(name, 0) >= WRITE_OFF_AFTER:
            return self._response(url, error="host written off", attempts=0)
        bucket = self.buckets.setdefault(name, Bucket(self.rate))
        began, error = self.clock(), ""
        for attempt in range(1, self.retries + 2):
            now = self.clock()
            self.sleep(max(0.0, bucket.acquire(now) - now))
            try:
                status, final, headers, body, cut = self.opener(url, method, {"User-Agent": self.agent}, self.timeout, self.max_bytes)
            except (OSError, ValueError) as e:
                error = f"{type(e).__name__}: {e}"
                if attempt <= self.retries:
                    self.sleep(self.delay(attempt))
                continue
            if status in vocab.RETRYABLE_STATUS and attempt <= self.retries:
                wait = self.retry_after(headers)
                if status == 429:
                    bucket.slow_to(max(wait, 2 / bucket.rate))
                self.sleep(wait or self.delay(attempt))
                continue
            self.failures[name] = 0 if 200 <= status < 400 else self.failures.get(name, 0) + 1
            out = self._response(url, final_url=final, status=status, headers=headers, content=body, attempts=attempt, truncated=cut, elapsed_s=self.clock() - began)
            if method == "GET":
                self.cache[url] = out
            return out
        self.failures[name] = self.failures.get(name, 0) + 1
        return self._response(url, error=error, attempts=self.retries + 1, elapsed_s=self.clock() - began)

    def head_or_get(self, url: str, name: str) -> dict:
        """HEAD; a GET instead where HEAD is not answered properly."""
        out = self.get(url, name, "HEAD")
        return self.get(url, name) if out["status"] in (405, 501) or (out["status"] == 200 and not out["headers"].get("content-length")) else out

    @staticmethod
    def _response(url: str, **values) -> dict:
        return {"url": url, "final_url": url, "status": 0, "headers": {}, "content": b"", "elapsed_s": 0.0, "error": "", "attempts": 0, "from_cache": False, "truncated": False, **values}


_ARROW = {"url": pa.string(), "final_url": pa.string(), "status": pa.int32(), "headers": pa.map_(pa.string(), pa.string()), "content": pa.binary(), "elapsed_s": pa.float64(), "error": pa.string(), "attempts": pa.int32(), "from_cache": pa.bool_(), "truncated": pa.bool_()}


def fetch(urls: DataFrame, url_col: str = "url", **client) -> DataFrame:
    """Responses of distinct URLs (the first of equal canonical ones). A host's URLs are one partition's work, so its pace holds; parallelism is the number of hosts."""
    ship(urls.sparkSession)
    once = urls.select(F.col(url_col).alias("url")).groupBy(normalise_url(F.col("url")).alias("key")).agg(F.min("url").alias("url"))

    def run(batches):
        own = Client(**client)
        for batch in batches:
            for url, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = own.get(url, name)
                yield pa.RecordBatch.from_arrays([pa.array([list(got[k].items()) if k == "headers" else got[k]], t) for k, t in _ARROW.items()], names=list(_ARROW))

    return once.select("url", host(F.col("url")).alias("host")).repartition("host").mapInArrow(run, RESPONSE)


def replay(urls: DataFrame, responses: DataFrame, url_col: str = "url") -> DataFrame:
    """Stored responses by canonical URL; status 0 where there is none."""
    known = responses.withColumn("_key", normalise_url(F.col("url"))).dropDuplicates(["_key"]).withColumnRenamed("url", "_url")
    wanted = urls.select(F.col(url_col).alias("url")).distinct().withColumn("_key", normalise_url(F.col("url")))
    return wanted.join(known, "_key", "left").drop("_key", "_url").withColumn("status", F.coalesce("status", F.lit(0)))
