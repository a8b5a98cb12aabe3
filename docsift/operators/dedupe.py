"""Entity resolution of catalogue rows: exact URL first, then transitive merging by hash, number and title.

Rows carry seq, their input order.  Every key holds the payer, but one payer may
hold most rows, so rows are never gathered by payer: keys are exploded, each key
links its rows to its first one, and components are found by star rewrites.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsift.functions import vocab
from docsift.functions.text import clean_text, title_key
from docsift.functions.urls import normalise_url
from docsift.operators.components import connected_components


def winner_order() -> list[Column]:
    """A total order, best row first: dates, confidence, status, file type, then the shallowest, shortest, first URL."""
    url = F.col("document_url")
    newest = lambda name: F.nullif(F.col(name), F.lit("")).desc_nulls_last()
    rank = F.coalesce(*[F.when(F.col("file_type") == t, F.lit(r)) for t, r in (("pdf", 0), ("docx", 1), ("doc", 1), ("xlsx", 2), ("xls", 2), ("html", 3))], F.lit(4))
    return [
        newest("effective_date"), newest("last_updated_date"), F.coalesce(F.col("confidence_score").try_cast("double"), F.lit(0.0)).desc(),
        F.when(F.col("http_status") == "200", F.lit(0)).otherwise(F.lit(1)), rank,
        F.length(url) - F.length(F.replace(url, F.lit("/"), F.lit(""))), F.length(url), url, F.col("seq"),
    ]


def cluster_keys() -> Column:
    """array of struct(tier, key): the keys a row can merge on, strongest first."""
    payer = F.lower(F.col("payer_name"))
    number = F.upper(F.trim(F.col("policy_number")))
    key = title_key(F.col("document_title"))
    sep = F.lit("\u0001")
    made = lambda tier, cond, *parts: F.when(cond, F.struct(F.lit(tier).alias("tier"), F.concat(*[x for p in parts for x in (p, sep)]).alias("key")))
    keys = F.array(
        made(0, (F.col("content_hash_sha256") != "") & (F.col("http_status") == "200"), payer, F.col("content_hash_sha256")),
        made(1, number != "", payer, number, F.col("document_type")),
        made(2, key != "", payer, F.col("document_type"), key, F.col("file_type")),
    )
    return F.filter(keys, lambda k: k.isNotNull())


def _collapse(rows: DataFrame, group: str, tier: Column) -> DataFrame:
    """One row per group, the winner, with n_dropped, tier and a note of what was dropped."""
    best = Window.partitionBy(group).orderBy(*winner_order())
    whole = Window.partitionBy(group)
    ranked = rows.withColumns({"_place": F.row_number().over(best), "_n": F.count(F.lit(1)).over(whole)})
    # the example is the first dropped row in input order
    ranked = ranked.withColumn("_example", F.min(F.when(F.col("_place") > 1, F.struct("seq", "document_url"))).over(whole)["document_url"])
    detail = F.concat(F.lit("collapsed "), (F.col("_n") - 1).cast("string"), F.lit(" near-duplicate URL(s) under the '"), tier, F.lit("' rule (e.g. "), F.col("_example"), F.lit(")"))
    notes = F.substring(clean_text(F.when(F.col("notes") != "", F.concat(F.col("notes"), F.lit("; "), detail)).otherwise(detail)), 1, 1000)
    kept = ranked.where("_place = 1").withColumns({"notes": F.when(F.col("_n") > 1, notes).otherwise(F.col("notes")), "n_dropped": F.col("_n") - 1, "tier": F.when(F.col("_n") > 1, tier)})
    return kept.drop("_place", "_n", "_example")


def collapse_urls(rows: DataFrame) -> DataFrame:
    """Tier 0: the winner of each canonical URL, across payers."""
    return _collapse(rows.withColumn("url_key", normalise_url(F.col("document_url"))), "url_key", F.lit("exact_url"))


def components(rows: DataFrame, store: Callable[[DataFrame], DataFrame], tiers: tuple[int, ...] = (0, 1, 2)) -> DataFrame:
    """rows with component (the least seq of the merged rows) and component_tier (0 to 2, the strongest that merged, null alone)."""
    keyed = rows.select("seq", F.explode(cluster_keys()).alias("k")).select("seq", "k.tier", "k.key").where(F.col("tier").isin(*tiers))
    firsts = keyed.groupBy("tier", "key").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    edges = store(keyed.join(firsts.drop("n"), ["tier", "key"]).where("seq != first").select(F.col("seq").alias("src"), F.col("first").alias("dst"), "tier"))
    roots = connected_components(edges.select("src", "dst"), store)
    strongest = edges.join(roots, edges["dst"] == roots["node"]).groupBy("root").agg(F.min("tier").alias("component_tier"))
    placed = roots.join(strongest, "root").select(F.col("node").alias("seq"), F.col("root").alias("component"), "component_tier")
    return rows.join(placed, "seq", "left").withColumn("component", F.coalesce("component", "seq"))


def tier_name(c: Column) -> Column:
    return F.get(F.array(*[F.lit(t) for t in vocab.TIERS]), c)


def collapse_components(rows: DataFrame, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Tiers 1 to 3: the winner of each component."""
    placed = components(rows, store)
    if "dropped_urls" in rows.columns:  # what the dropped rows had dropped before counts for the survivor
        placed = placed.withColumn("dropped_urls", F.sum("dropped_urls").over(Window.partitionBy("component")))
    return _collapse(placed, "component", tier_name(F.col("component_tier")))


def dedupe(rows: DataFrame, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All tiers; survivors with dropped_urls (tier 0), n_dropped and tier (later tiers), in input order by seq."""
    first = store(collapse_urls(rows).withColumnRenamed("n_dropped", "dropped_urls").drop("tier"))
    return collapse_components(first, store).drop("component_tier")


def dedupe_report(kept: DataFrame) -> DataFrame:
    """Collapsed rows by tier and by payer, with totals: rows (kind, name, n)."""
    parts = kept.select("payer_name", F.explode(F.array(F.struct(F.lit("exact_url").alias("tier"), F.col("dropped_urls").alias("n")), F.struct("tier", F.col("n_dropped").alias("n")))).alias("p")).select("payer_name", "p.tier", "p.n").where("n > 0")
    counts = parts.groupingSets([[F.col("tier")], [F.col("payer_name")], []], F.col("tier"), F.col("payer_name")).agg(F.sum("n").alias("n"))
    kinds = counts.select(F.when(F.col("tier").isNotNull(), F.lit("tier")).when(F.col("payer_name").isNotNull(), F.lit("payer")).otherwise(F.lit("collapsed")).alias("kind"), F.coalesce("tier", "payer_name", F.lit("")).alias("name"), "n")
    return kinds.unionByName(kept.agg(F.count(F.lit(1)).alias("n")).select(F.lit("kept").alias("kind"), F.lit("").alias("name"), "n"))


def rule_description() -> str:
    """How duplicates are merged, in words."""
    return (
        "Rows with one canonical URL are one document. Rows of one payer are merged, transitively, when they share the "
        "content hash of a 200 response, the policy number and document type, or the title key with document and file type. "
        "The survivor has the latest effective date, then update date, then the highest confidence, a 200 status, the most "
        "canonical file type, and the shallowest, shortest, first URL; its notes name the rule and one URL that was dropped."
    )
