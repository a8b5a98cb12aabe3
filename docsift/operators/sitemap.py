"""Sitemaps: tolerant parsing by patterns, gzip bodies, and the budgeted walk over nested indexes."""

from __future__ import annotations

import gzip
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsift.functions import vocab
from docsift.functions.text import clean_text, contains_any
from docsift.functions.urls import normalise_url
from docsift.session import ship

_ENTRY = r"(?is)<(?:url|sitemap)(?=[ \t\r\n>])[^>]*>(.*?)</(?:url|sitemap)\s*>"
_LOC = r"(?is)<loc>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</loc>"
_LASTMOD = r"(?is)<lastmod>\s*(.*?)\s*</lastmod>"


def is_index(text: Column) -> Column:
    return text.rlike(r"(?i)<sitemapindex")


def entries(text: Column) -> Column:
    """array of struct(loc, lastmod): closed blocks first, then any other loc; each loc once, where it came first."""
    blocks = F.transform(F.regexp_extract_all(text, F.lit(_ENTRY), F.lit(1)), lambda b: F.struct(clean_text(F.regexp_extract(b, _LOC, 1)).alias("loc"), clean_text(F.regexp_extract(b, _LASTMOD, 1)).alias("lastmod")))
    loose = F.transform(F.regexp_extract_all(text, F.lit(_LOC), F.lit(1)), lambda x: F.struct(clean_text(x).alias("loc"), F.lit("").alias("lastmod")))
    web = F.filter(F.concat(blocks, loose), lambda e: F.lower(e["loc"]).rlike("^https?://"))
    names = F.transform(web, lambda e: e["loc"])
    return F.filter(web, lambda e, i: F.array_position(names, e["loc"]) == i + 1)


def parse_sitemaps(files: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (keep..., is_index, seq, loc, lastmod)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = files.select(*keep, is_index(text).alias("is_index"), F.posexplode(entries(text)).alias("seq", "e"))
    return rows.select(*keep, "is_index", "seq", F.col("e.loc").alias("loc"), F.col("e.lastmod").alias("lastmod"))


def unpacked(files: DataFrame, content_col: str = "content", out: str = "text") -> DataFrame:
    """files with text: gzip bodies unpacked (a broken one stays as it is), decoded as UTF-8, else Windows-1252."""
    ship(files.sparkSession)
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def text(column):
        def one(body):
            body = body or b""
            if body[:2] == b"\x1f\x8b":
                try:
                    body = gzip.decompress(body)
                except (OSError, EOFError, ValueError):
                    pass
            try:
                return body.decode("utf-8")
            except UnicodeDecodeError:
                return body.decode("cp1252", "replace")

        return column.map(one)

    return files.withColumn(out, text(F.col(content_col)))


def walk(starts: DataFrame, responses: DataFrame, store: Callable[[DataFrame], DataFrame], budget: int = 40, depth: int = 4) -> DataFrame:
    """Page URLs (payer, loc, lastmod) of declared sitemaps and the indexes they lead to.

    starts: payer, url, seq; responses: url, text.  Level by level: at most `budget`
    sitemaps a payer, hinted ones first, none twice.
    """
    seen = None
    level = starts.select("payer", F.col("url").alias("loc"), F.col("seq").cast("long").alias("seq"))
    pages = None
    for _ in range(depth):
        keyed = level.withColumn("key", normalise_url(F.col("loc")))
        if seen is not None:
            keyed = keyed.join(seen.select("payer", "key"), ["payer", "key"], "left_anti")
            used = seen.groupBy("payer").agg(F.count(F.lit(1)).alias("used"))
        order = Window.partitionBy("payer").orderBy(contains_any(F.lower("loc"), vocab.POLICY_PATH_HINTS).cast("int").desc(), "seq")
        keyed = keyed.groupBy("payer", "key").agg(F.min_by("loc", "seq").alias("loc"), F.min("seq").alias("seq")).withColumn("place", F.row_number().over(order))
        if seen is not None:
            keyed = keyed.join(used, "payer", "left").where(F.col("place") + F.coalesce("used", F.lit(0)) <= budget).drop("used")
        else:
            keyed = keyed.where(F.col("place") <= budget)
        taken = store(keyed.drop("place"))
        if not taken.limit(1).count():
            break
        seen = taken.select("payer", "key") if seen is None else seen.unionByName(taken.select("payer", "key"))
        found = store(parse_sitemaps(taken.join(responses.withColumn("key", normalise_url(F.col("url"))).select("key", "text"), "key"), "text", ("payer", F.col("seq").alias("parent"))))
        own = found.where("not is_index").select("payer", "loc", "lastmod")
        pages = own if pages is None else pages.unionByName(own)
        level = found.where("is_index").select("payer", "loc", (F.col("parent") * 100_000 + F.col("seq")).alias("seq"))
    empty = starts.sparkSession.createDataFrame([], "payer string, loc string, lastmod string")
    return empty if pages is None else pages.groupBy("payer", "loc").agg(F.max("lastmod").alias("lastmod"))


