"""Discovery as an iterative dataflow over a table of responses.

Each hop is a wave of joins: candidates against what was seen (anti join), against
robots rules, against responses; links of the answered pages become the next wave.
Budgets are ranks per payer.  Waves are written to the shared folder, so no lineage
grows and a lost executor repeats one wave at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsift.functions.classify import score_candidate
from docsift.functions.sniff import auth_gate, challenge, charset, decode_text, detect_file_type, ok, sniff_kind
from docsift.functions.urls import anchor_selector, has_policy_hint, host, in_scope, is_html_policy_page, is_noise, looks_like_document_url, looks_like_policy_index, normalise_url, page_label
from docsift.functions.text import trim_label
from docsift.operators.enumeration import candidates, templates
from docsift.operators.html import extract_links
from docsift.operators.report import outcome
from docsift.operators.robots import decide

CANDIDATE = "payer_name string, url string, source_page_url string, discovery_path string, origin string, link_text string, priority double, depth int, seq long"


def seed_candidates(payers: DataFrame, sitemap_entries: DataFrame | None = None) -> DataFrame:
    """First index pages: sitemap entries (documents 3.0, listings 1.5, 0.2 more when dated), seed paths (2.5), the home page (0.5)."""
    from docsift.functions.urls import resolve

    base = F.concat(F.lit("https://"), F.col("hint_host"), F.lit("/"))
    seeds = payers.select("payer_name", "position", base.alias("base"), F.posexplode("seed_paths").alias("at", "p"))
    seeded = seeds.select("payer_name", resolve(F.col("base"), F.col("p")).alias("url"), F.col("base").alias("source_page_url"), F.concat(F.lit("seed:"), F.col("p")).alias("discovery_path"), F.lit("index").alias("origin"), F.lit("").alias("link_text"), F.lit(2.5).alias("priority"), F.lit(0).alias("depth"), (F.col("position") * 1_000_000 + F.col("at") + 1).cast("long").alias("seq"))
    home = payers.select("payer_name", base.alias("url"), F.lit("").alias("source_page_url"), F.lit("home").alias("discovery_path"), F.lit("index").alias("origin"), F.lit("").alias("link_text"), F.lit(0.5).alias("priority"), F.lit(0).alias("depth"), (F.col("position") * 1_000_000).cast("long").alias("seq"))
    out = seeded.where(F.col("url").isNotNull()).unionByName(home)
    if sitemap_entries is not None:
        url = F.col("loc")
        known = sitemap_entries.withColumnRenamed("payer", "payer_name").join(payers.select("payer_name", "position", "hint_host", "extra_hosts"), "payer_name")
        wanted = known.where(in_scope(host(url), F.col("hint_host"), F.col("extra_hosts")) & ~is_noise(url) & (looks_like_document_url(url) | has_policy_hint(url)))
        priority = F.when(looks_like_document_url(url), F.lit(3.0)).otherwise(F.lit(1.5)) + F.when(F.coalesce("lastmod", F.lit("")) != "", F.lit(0.2)).otherwise(F.lit(0.0))
        origin = F.when(looks_like_document_url(url), F.lit("sitemap_doc")).otherwise(F.lit("sitemap"))
        order = F.row_number().over(Window.partitionBy("payer_name").orderBy("loc"))
        out = out.unionByName(wanted.select("payer_name", url.alias("url"), F.lit("").alias("source_page_url"), F.concat(F.lit("sitemap > "), page_label(url)).alias("discovery_path"), origin.alias("origin"), F.lit("").alias("link_text"), priority.alias("priority"), F.lit(0).alias("depth"), (F.col("position") * 1_000_000 + 500_000 + order).cast("long").alias("seq")))
    return out


def links_of(pages: DataFrame, payers: DataFrame) -> DataFrame:
    """Candidates from answered index pages (payer_name, url, html, discovery_path, depth, seq): documents, and listings one hop on."""
    links = extract_links(pages.withColumnRenamed("seq", "parent"), "html", "url", ("payer_name", "url", "discovery_path", "depth", "parent"))
    known = links.join(payers.select("payer_name", "hint_host", "extra_hosts"), "payer_name")
    target = F.col("link")
    useful = known.where(in_scope(host(target), F.col("hint_host"), F.col("extra_hosts")) & ~is_noise(target))
    document = looks_like_document_url(target)
    listing = ~document & (looks_like_policy_index(F.col("text")) | has_policy_hint(target))
    kept = useful.where(document | (listing & (F.col("depth") < 2)))
    score = score_candidate(target, F.col("text"))
    return kept.select(
        "payer_name", target.alias("url"), F.col("url").alias("source_page_url"),
        F.concat_ws(" > ", "discovery_path", F.concat(F.lit("index:"), page_label(F.col("url"))), F.when(document, F.concat(anchor_selector(target), F.lit(" '"), trim_label(F.col("text")), F.lit("'")))).alias("discovery_path"),
        F.when(document, F.lit("anchor")).otherwise(F.lit("index")).alias("origin"), F.col("text").alias("link_text"),
        F.when(document, score).otherwise(F.lit(1.0) + F.lit(0.3) * score).alias("priority"), (F.col("depth") + 1).alias("depth"), (F.col("parent") * 1000 + F.col("seq")).cast("long").alias("seq"),
    )


def _first_of_each(candidates: DataFrame) -> DataFrame:
    """Candidates with key, the best of equal canonical URLs of a payer: highest priority, then first."""
    keyed = candidates.withColumn("key", normalise_url(F.col("url")))
    best = F.row_number().over(Window.partitionBy("payer_name", "key").orderBy(F.desc("priority"), "seq"))
    return keyed.withColumn("_n", best).where("_n = 1").drop("_n")


def discover(payers: DataFrame, responses: DataFrame, rules: DataFrame, store: Callable[[DataFrame], DataFrame], sitemap_entries: DataFrame | None = None, index_pages: int = 25, max_docs: int = 50, hops: int = 3, policies: DataFrame | None = None) -> DataFrame:
    """Document candidates with their outcome, per payer: at most index_pages listings in all and max_docs documents, by priority.

    Robots rules (and policies, see decide()) come before budgets, so what they deny uses up no place.

    responses: url, status, headers (map), content, final_url.  Pages that are policy
    documents themselves join the documents.
    """
    answered = responses.withColumn("key", normalise_url(F.col("url"))).dropDuplicates(["key"]).drop("url")
    frontier = _first_of_each(seed_candidates(payers, sitemap_entries))
    documents = frontier.where("origin = 'sitemap_doc'")
    frontier = store(frontier.where("origin != 'sitemap_doc'"))
    seen = None
    for _ in range(hops):
        order = Window.partitionBy("payer_name").orderBy(F.desc("priority"), "seq")
        wave = frontier if seen is None else frontier.join(seen, ["payer_name", "key"], "left_anti")
        wave = decide(wave, rules, policies=policies).where("allowed").drop("allowed", "reason", "matched_rule").withColumn("_n", F.row_number().over(order))
        if seen is not None:
            used = seen.groupBy("payer_name").agg(F.count(F.lit(1)).alias("_used"))
            wave = wave.join(used, "payer_name", "left").withColumn("_n", F.col("_n") + F.coalesce("_used", F.lit(0))).drop("_used")
        wave = store(wave.where(F.col("_n") <= index_pages).drop("_n"))
        if not wave.limit(1).count():
            break
        seen = wave.select("payer_name", "key") if seen is None else seen.unionByName(wave.select("payer_name", "key"))
        pages = wave.join(answered, "key").where((F.col("status") == 200) & (challenge(F.col("status"), F.col("headers"), F.col("content")) == ""))
        pages = pages.withColumn("html", decode_text(F.col("content"), charset(F.try_element_at(F.col("headers"), F.lit("content-type")))))
        itself = pages.where(is_html_policy_page(F.col("url"), F.col("html"))).withColumn("origin", F.lit("html_policy")).select(wave.columns)
        links = _first_of_each(links_of(pages.select("payer_name", "url", "html", "discovery_path", "depth", "seq"), payers))
        found = store(links.unionByName(itself))
        documents = documents.unionByName(found.where("origin in ('anchor', 'html_policy')"))
        frontier = found.where("origin = 'index'")
    wanted = _first_of_each(documents.drop("key"))
    place = F.row_number().over(Window.partitionBy("payer_name").orderBy(F.desc("priority"), "seq"))
    chosen = decide(wanted.withColumn("place", place), rules, policies=policies)
    return resolve_documents(within_budget(chosen, max_docs, answered), answered)


def within_budget(candidates: DataFrame, max_docs: int, answered: DataFrame) -> DataFrame:
    """candidates (payer_name, place, key, allowed) in order, up to the one that makes max_docs found (answered with 200); those not found use up no place."""
    good = answered.where((F.col("status") == 200) & (F.length("content") > 0)).select("key").distinct().withColumn("_good", F.lit(1))
    before = Window.partitionBy("payer_name").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    hit = F.when(F.col("allowed"), F.coalesce("_good", F.lit(0))).otherwise(F.lit(0))
    marked = candidates.join(good, "key", "left").withColumn("_found", F.coalesce(F.sum(hit).over(before), F.lit(0)))
    return marked.where(F.col("_found") < max_docs).drop("_good", "_found")


def resolve_documents(candidates: DataFrame, answered: DataFrame) -> DataFrame:
    """candidates (with key and allowed) joined with their responses, and what becomes of each."""
    joined = candidates.join(answered, "key", "left").withColumn("status", F.coalesce("status", F.lit(0)))
    c = F.col
    header = F.coalesce(F.try_element_at(c("headers"), F.lit("content-type")), F.lit(""))
    wall, gate = challenge(c("status"), c("headers"), c("content")), auth_gate(c("status"), c("content"), F.coalesce(c("final_url"), c("url")))
    kind = detect_file_type(c("content"), header, c("url"))
    became = outcome(F.lit(False), c("allowed"), c("status"), F.coalesce(wall, F.lit("")), F.coalesce(gate, F.lit("")), F.coalesce(ok(c("status"), c("content")), F.lit(False)), kind, F.coalesce(sniff_kind(c("content")), F.lit("")))
    return joined.withColumns({"outcome": became, "file_type": kind, "evidence": F.coalesce(F.nullif(wall, F.lit("")), F.nullif(gate, F.lit("")), F.lit(""))})


def enumerate_documents(found: DataFrame, withheld: DataFrame, responses: DataFrame, rules: DataFrame, budget: int = 20, policies: DataFrame | None = None) -> DataFrame:
    """Neighbours of numbered documents, for payers whose robots rules withhold something helpful.

    found: payer_name, document_url, seq of documents that answered; withheld: payer_name.
    Candidates that robots rules allow meet their responses; a payer's candidates after
    its first refusal are left out.  What comes back still needs verify_enumerated().
    """
    tried = candidates(templates(found), budget).join(withheld.select("payer_name").distinct(), "payer_name", "left_semi")
    known = found.select("payer_name", normalise_url(F.col("document_url")).alias("key")).distinct()
    tried = tried.select("payer_name", "url", F.col("place").cast("long").alias("seq"), F.lit("url_pattern").alias("origin"), F.concat(F.lit("enumerated: "), F.col("prefix"), F.lit("{n}"), F.col("suffix")).alias("discovery_path"))
    tried = tried.withColumn("key", normalise_url(F.col("url"))).join(known, ["payer_name", "key"], "left_anti")
    answered = responses.withColumn("key", normalise_url(F.col("url"))).dropDuplicates(["key"]).drop("url")
    became = resolve_documents(decide(tried, rules, policies=policies).where("allowed"), answered)
    refused = became.where("outcome = 'challenged'").groupBy("payer_name").agg(F.min("seq").alias("_stop"))
    return became.join(refused, "payer_name", "left").where(F.col("_stop").isNull() | (F.col("seq") <= F.col("_stop"))).drop("_stop")


def blocks(documents: DataFrame) -> DataFrame:
    """Payers that were refused, with the first evidence."""
    return documents.where("outcome = 'challenged'").groupBy("payer_name").agg(F.min_by("evidence", "seq").alias("block_evidence")).withColumn("blocked", F.lit(True))
