"""Counters, verdicts, totals and the summary table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ("attempted", "found", "failed", "skipped_robots", "dupes_collapsed")


def counters(outcomes: DataFrame, by: str = "payer_name") -> DataFrame:
    """Per-payer counts of document outcomes (column outcome: ok, failed, challenged, gated, non_200, unrecognised, robots)."""
    o = F.col("outcome")
    failed = o.isin("failed", "challenged", "gated", "non_200")
    return outcomes.groupBy(by).agg(
        F.count_if(o.isin("ok", "unrecognised") | failed).alias("attempted"),
        F.count_if(o == "ok").alias("found"),
        F.count_if(failed).alias("failed"),
        F.count_if(o == "robots").alias("skipped_robots"),
        F.bool_or(o == "challenged").alias("blocked"),
    )


def outcome(seen: Column, allowed: Column, status: Column, challenged: Column, gated: Column, ok: Column, file_type: Column, sniffed: Column) -> Column:
    """The document ladder: what becomes of a candidate; duplicate for one already seen."""
    return (
        F.when(seen, F.lit("duplicate"))
        .when(~allowed, F.lit("robots"))
        .when(status == 0, F.lit("failed"))
        .when(challenged != "", F.lit("challenged"))
        .when(gated != "", F.lit("gated"))
        .when(~ok, F.lit("non_200"))
        .when((file_type == "other") & (sniffed == ""), F.lit("unrecognised"))
        .otherwise(F.lit("ok"))
    )


def verdict() -> Column:
    """Why a payer's result is as it is, from its counters and status."""
    c = F.col
    text = lambda x: x.cast("string")
    return (
        F.when(c("blocked") & (c("found") == 0), F.lit("BLOCKED - automated access refused (see log for evidence)"))
        .when(c("blocked"), F.concat(F.lit("partial - "), text(c("found")), F.lit(" found before being blocked")))
        .when(c("status") == "failed", F.lit("FAILED - crawl error, see log"))
        .when((c("found") == 0) & (c("failed") > 0), F.concat(F.lit("no live documents - "), text(c("failed")), F.lit("/"), text(c("attempted")), F.lit(" discovered link(s) returned non-200; rows kept as evidence")))
        .when((c("found") == 0) & (c("skipped_robots") > 0), F.concat(F.lit("no documents - "), text(c("skipped_robots")), F.lit(" candidate(s) robots-disallowed")))
        .when(c("found") == 0, F.lit("no documents - crawled successfully, nothing publishable found"))
        .otherwise(F.lit("ok"))
    )


def payer_status(blocked: Column, found: Column) -> Column:
    return F.when(blocked & (found == 0), F.lit("blocked")).otherwise(F.lit("done"))


def with_totals(stats: DataFrame, by: str = "payer_name") -> DataFrame:
    """Per-payer sums and a TOTAL row, in one rollup."""
    rolled = stats.rollup(by).agg(*[F.sum(m).alias(m) for m in MEASURES], F.grouping(by).alias("_all"))
    return rolled.select(F.when(F.col("_all") == 1, F.lit("TOTAL")).otherwise(F.col(by)).alias(by), *MEASURES)


def merge_stats(live: DataFrame, kept: DataFrame, by: str = "payer_name") -> DataFrame:
    """Live counters over the checkpoint's, field by field."""
    names = [n for n in live.columns if n != by]
    a, b = live.alias("a"), kept.alias("b")
    return a.join(b, by, "full_outer").select(by, *[F.coalesce(F.col(f"a.{n}"), F.col(f"b.{n}")).alias(n) for n in names])


def in_seed_order(payers: DataFrame, stats: DataFrame, by: str = "payer_name") -> DataFrame:
    """Seed payers by position with their stats, then others by name."""
    first = payers.join(stats, by, "left").withColumn("listed", F.lit(0))
    rest = stats.join(payers, by, "left_anti").withColumns({"position": F.lit(None).cast("int"), "listed": F.lit(1)})
    return first.unionByName(rest, allowMissingColumns=True).orderBy("listed", "position", by)


def summary_line() -> Column:
    """One line of the fixed-width table; null counts are 0."""
    n = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("long")
    return F.format_string(
        "%3s  %-34s %9d %6d %7d %8d %6d %7.1fs  %s",
        F.col("position").cast("string"), F.substring("payer_name", 1, 34), n("attempted"), n("found"), n("failed"), n("skipped_robots"), n("dupes_collapsed"), F.coalesce(F.col("elapsed_s"), F.lit(0.0)).cast("double"), F.col("outcome"),
    )


def log_stats(stats: DataFrame) -> DataFrame:
    """Counters as logged: seconds to two decimals, empty evidence as null."""
    return stats.withColumns({"elapsed_s": F.round("elapsed_s", 2), "block_evidence": F.nullif(F.col("block_evidence"), F.lit(""))})


def fetch_stats(responses: DataFrame) -> DataFrame:
    """Requests, retries, failures, cache hits and bytes in one pass."""
    return responses.agg(
        F.count_if(~F.col("from_cache")).alias("requests"), F.sum(F.greatest(F.col("attempts") - 1, F.lit(0))).alias("retries"), F.count_if(F.col("status") == 0).alias("failures"),
        F.count_if("from_cache").alias("cache_hits"), F.sum(F.coalesce(F.length("content"), F.lit(0))).alias("bytes"),
    )


def duplicate_urls(rows: DataFrame) -> DataFrame:
    """URLs that more than one row has; empty after deduplication."""
    return rows.groupBy("document_url").count().where("count > 1")
