"""Numeric URL templates inferred from found documents, and the bounded list of neighbours to try."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsift.functions.urls import part, path


def templates(rows: DataFrame, url_col: str = "document_url", by: str = "payer_name", seq: str = "seq") -> DataFrame:
    """(by, prefix, suffix, numbers): the URL template with the most distinct numbers (three or more), the first of equals.

    Each run of two or more digits of a path is one candidate place.  Leading zeros are
    not kept in numbers.
    """
    url = F.col(url_col)
    root = F.concat(part(url, 1), F.lit("://"), part(url, 2))
    pieces = F.filter(F.regexp_extract_all(path(url), F.lit(r"(\d{2,}|\d(?!\d)|\D+)"), F.lit(1)), lambda p: p != "")
    split = rows.select(F.col(by), F.col(seq).alias("seq"), root.alias("root"), pieces.alias("pieces"))
    spots = split.select(by, "seq", "root", "pieces", F.posexplode("pieces").alias("at", "digits")).where(F.col("digits").rlike(r"^\d{2,}$"))
    spots = spots.select(
        by, "seq", "at",
        F.concat(F.col("root"), F.array_join(F.slice("pieces", F.lit(1), F.col("at")), "")).alias("prefix"),
        F.array_join(F.slice("pieces", F.col("at") + 2, F.size("pieces")), "").alias("suffix"),
        F.col("digits").try_cast("decimal(38,0)").alias("number"),
    )
    groups = spots.groupBy(by, "prefix", "suffix").agg(F.sort_array(F.collect_set("number")).alias("numbers"), F.min(F.struct("seq", "at")).alias("first")).where(F.size("numbers") >= 3)
    best = Window.partitionBy(by).orderBy(F.size("numbers").desc(), "first")
    return groups.withColumn("_place", F.row_number().over(best)).where("_place = 1").drop("_place", "first")


def candidates(found: DataFrame, budget: int) -> DataFrame:
    """found (as of templates()) with a row per URL to try: above the range, below it, then the gaps, `budget` at most.

    Gaps are differences of neighbours in the sorted numbers, so the work is that of
    reading the numbers once, however wide their range is.
    """
    low, high = F.element_at("numbers", 1), F.element_at("numbers", -1)
    width = high - low
    span = F.greatest(F.lit(4), F.least(F.lit(budget // 2), F.when(width == 0, F.lit(8)).otherwise(width))).cast("int")
    whole = lambda n: n.cast("decimal(38,0)")
    count = lambda n: F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    under = F.least(span, low - 1).cast("int")
    edges = F.concat(F.transform(count(span), lambda k: whole(high + k)), F.transform(count(under), lambda k: whole(low - (under + 1 - k))))
    pairs = F.zip_with("numbers", F.slice("numbers", F.lit(2), F.size("numbers")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    holes = F.slice(F.filter(pairs, lambda p: p["b"] - p["a"] > 1), 1, budget)
    gaps = F.flatten(F.transform(holes, lambda p: F.transform(count(F.least(F.lit(budget), p["b"] - p["a"] - 1).cast("int")), lambda k: whole(p["a"] + k))))
    wanted = F.slice(F.when(F.size(edges) >= budget, edges).otherwise(F.concat(edges, gaps)), 1, budget)
    rows = found.select("*", F.posexplode(wanted).alias("place", "number"))
    return rows.withColumn("url", F.concat("prefix", F.col("number").cast("string"), "suffix"))
