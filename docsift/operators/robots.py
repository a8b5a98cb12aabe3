"""robots.txt as tables: parsing, choice of group, and the longest-match decision as a join.

Rules are a table with a row per rule; the decision joins URLs with the rules of
their host on the host (an equality, so large sides shuffle by host) and takes the
longest match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsift.functions import vocab
from docsift.functions.classify import helpful_disallow
from docsift.functions.text import percent_decode
from docsift.functions.sniff import robots_policy
from docsift.functions.urls import host, robots_path


def parse_robots(files: DataFrame, host_col: str = "host", text_col: str = "text") -> DataFrame:
    """A row per line that says something: host, line, kind, value, agents and group_no.

    kind is rule_allow, rule_disallow, crawl_delay, sitemap or unknown.  Neighbouring
    User-agent lines share a group; a Sitemap line leaves the run of agents open, any
    other known directive closes it.  Rules before any agent belong to `*` (group 0).
    """
    text = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), "^﻿", "")
    lines = files.select(F.col(host_col).alias("host"), F.posexplode(F.split(text, r"\r\n|\r|\n")).alias("line", "raw"))
    body = F.trim(F.regexp_replace("raw", r"#.*\z", ""))
    lines = lines.withColumn("body", body).where("body != ''")
    has_colon = F.contains(F.col("body"), F.lit(":"))
    name = F.when(has_colon, F.lower(F.trim(F.substring_index("body", ":", 1)))).otherwise(F.lit(""))
    value = F.trim(F.regexp_replace("body", r"^[^:]*:", ""))
    lines = lines.withColumns({"name": name, "value": F.when(has_colon, value).otherwise(F.col("body"))})
    lines = lines.withColumn("known", F.col("name").isin(*vocab.ROBOTS_DIRECTIVES))
    agent = F.col("name") == "user-agent"
    order = Window.partitionBy("host").orderBy("line")  # the lines of one file
    closing = F.col("known") & ~agent & (F.col("name") != "sitemap")
    last = F.last(F.when(agent | closing, agent), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    lines = lines.withColumn("opens", agent & ~F.coalesce(last, F.lit(False)))
    lines = lines.withColumn("group_no", F.sum(F.col("opens").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    agents = F.collect_list(F.when(agent, F.lower(F.col("value")))).over(Window.partitionBy("host", "group_no"))
    lines = lines.withColumn("agents", F.when(F.col("group_no") == 0, F.array(F.lit("*"))).otherwise(agents))
    delay = F.col("value").try_cast("double")
    kind = (
        F.when((F.col("name") == "allow") & (F.col("value") != ""), F.lit("rule_allow"))
        .when((F.col("name") == "disallow") & (F.col("value") != ""), F.lit("rule_disallow"))
        .when((F.col("name") == "sitemap") & (F.col("value") != ""), F.lit("sitemap"))
        .when((F.col("name") == "crawl-delay") & (delay > 0), F.lit("crawl_delay"))
        .when((F.col("name") == "crawl-delay") & delay.isNull(), F.lit("unknown"))
        .when(~F.col("known"), F.lit("unknown"))
        .when(agent, F.lit("agent"))
    )
    out = lines.select("host", "line", kind.alias("kind"), F.when(kind == "crawl_delay", F.least(delay, F.lit(30.0)).cast("string")).when(kind == "unknown", F.substring("body", 1, 120)).otherwise(F.col("value")).alias("value"), "agents", "group_no")
    return out.where(F.col("kind").isNotNull())


def choose_group(parsed: DataFrame, user_agent: str) -> DataFrame:
    """(host, group_no): the group with the longest agent token within the user agent, the first of equals; else the first `*` group."""
    tokens = parsed.select("host", "group_no", F.explode(F.array_distinct("agents")).alias("token")).distinct()
    low = user_agent.lower()
    fits = tokens.where((F.col("token") == "*") | ((F.col("token") != "") & F.contains(F.lit(low), F.col("token"))))
    best = F.min(F.struct((F.col("token") == "*").alias("wild"), (-F.length("token")).alias("n"), "group_no"))
    return fits.groupBy("host").agg(best.alias("b")).select("host", F.col("b.group_no").alias("group_no"))


def rule_regex(raw: Column) -> Column:
    """A rule's path as an anchored pattern: `*` any run, a last `$` the end, all else literal."""
    body = F.regexp_replace(raw, r"\$\z", "")
    parts = F.transform(F.split(body, r"\*"), lambda p: F.concat(F.lit(r"\Q"), F.replace(p, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")))
    return F.concat(F.lit("(?is)^"), F.array_join(parts, ".*"), F.when(raw.endswith("$"), F.lit(r"\z")).otherwise(F.lit("")))


def rule_length(raw: Column) -> Column:
    """Specificity: the decoded pattern without wildcards and the end mark."""
    return F.length(F.replace(F.regexp_replace(percent_decode(raw), r"\$\z", ""), F.lit("*"), F.lit("")))


def rules_for(parsed: DataFrame, user_agent: str) -> DataFrame:
    """(host, rule_no, allow, raw, pattern, length) of the group that applies to a user agent."""
    rules = parsed.where(F.col("kind").isin("rule_allow", "rule_disallow")).join(choose_group(parsed, user_agent), ["host", "group_no"])
    decoded = percent_decode(F.col("value"))
    return rules.select("host", F.col("line").alias("rule_no"), (F.col("kind") == "rule_allow").alias("allow"), F.col("value").alias("raw"), rule_regex(decoded).alias("pattern"), rule_length(F.col("value")).alias("length"))


def decide(urls: DataFrame, rules: DataFrame, url_col: str = "url", keys: tuple[str, ...] = (), policies: DataFrame | None = None) -> DataFrame:
    """urls with allowed, reason and matched_rule; rules as of rules_for(). Longest match wins, Allow on equal length, then the first.

    policies: (host, fetched, default_allow, note), as of policies_of(). Where rules were
    not fetched the host's default holds, and a host that has no answer at all is
    denied.  Without policies all hosts count as fetched.
    """
    sided = urls.withColumns({"_host": host(F.col(url_col)), "_path": robots_path(F.col(url_col)), "_row": F.struct(F.col(url_col), *keys)})
    if policies is not None:
        fetched = policies.where("fetched").select("host")
        rules = rules.join(fetched, "host", "left_semi")
    named = rules.withColumnRenamed("host", "_rule_host")
    hit = (F.col("_host") == F.col("_rule_host")) & F.expr("_path rlike pattern")
    pairs = sided.select("_host", "_path").distinct().join(named, hit)
    best = pairs.groupBy("_host", "_path").agg(F.max(F.struct("length", "allow", (-F.col("rule_no")).alias("first"), "raw")).alias("_best"))
    known = rules.select(F.col("host").alias("_host")).distinct().withColumn("_ruled", F.lit(True))
    out = sided.join(best, ["_host", "_path"], "left").join(known, "_host", "left")
    if policies is None:
        out = out.withColumns({"_default": F.lit(True), "_note": F.lit("")})
    else:
        out = out.join(policies.select(F.col("host").alias("_host"), F.col("default_allow").alias("_default"), F.col("note").alias("_note")), "_host", "left")
        out = out.withColumns({"_default": F.coalesce("_default", F.lit(False)), "_note": F.coalesce("_note", F.lit("robots.txt was never answered"))})
    said = F.when(F.col("_best.allow"), F.concat(F.lit("Allow: "), F.col("_best.raw"))).when(F.col("_best").isNotNull(), F.concat(F.lit("Disallow: "), F.col("_best.raw"))).otherwise(F.lit(""))
    reason = (
        F.when(F.col("_best.allow"), F.lit("explicitly allowed"))
        .when(F.col("_best").isNotNull(), F.lit("disallowed by robots.txt"))
        .when(F.col("_note") != "", F.col("_note"))
        .when(F.col("_ruled"), F.lit("no matching robots.txt rule"))
        .otherwise(F.lit("no applicable robots.txt rules"))
    )
    return out.withColumns({"allowed": F.coalesce(F.col("_best.allow"), F.col("_default")), "reason": reason, "matched_rule": said}).drop("_host", "_path", "_row", "_best", "_ruled", "_default", "_note")


def policies_of(responses: DataFrame) -> DataFrame:
    """(host, fetched, default_allow, note) of robots.txt responses (url, status, content); of several answers of a host the least status counts."""
    policy = robots_policy(F.col("status"), F.col("content"))
    rows = responses.select(host(F.col("url")).alias("host"), "status", policy.alias("p")).groupBy("host").agg(F.min_by("p", "status").alias("p"))
    return rows.select("host", "p.fetched", "p.default_allow", "p.note")


def crawl_delays(parsed: DataFrame, user_agent: str) -> DataFrame:
    """(host, crawl_delay) of the group that applies; the last line of a group counts."""
    delays = parsed.where("kind = 'crawl_delay'").join(choose_group(parsed, user_agent), ["host", "group_no"])
    return delays.groupBy("host").agg(F.max_by(F.col("value").cast("double"), "line").alias("crawl_delay"))


def helpful_disallowed(rules: DataFrame, limit: int = 8) -> DataFrame:
    """(host, path, rule): up to `limit` disallow rules a host, in order, that name something helpful."""
    found = rules.where(~F.col("allow") & helpful_disallow(F.col("raw")))
    path = F.regexp_replace("raw", r"[*$]", "")
    rows = found.select("host", "rule_no", F.when(path == "", F.lit("/")).otherwise(path).alias("path"), F.concat(F.lit("Disallow: "), F.col("raw")).alias("rule"))
    rows = rows.groupBy("host", "path", "rule").agg(F.min("rule_no").alias("rule_no"))
    place = F.row_number().over(Window.partitionBy("host").orderBy("rule_no"))
    return rows.withColumn("place", place).where(F.col("place") <= limit).drop("place")


def sitemaps(parsed: DataFrame) -> DataFrame:
    """(host, url): declared sitemaps, each once."""
    return parsed.where("kind = 'sitemap'").groupBy("host", F.col("value").alias("url")).agg(F.min("line").alias("line"))


def summary(parsed: DataFrame) -> DataFrame:
    """A row per host: groups, rules, sitemaps and the delay for all agents."""
    counts = parsed.groupBy("host").agg(
        F.countDistinct(F.when(F.col("kind").isin("agent", "rule_allow", "rule_disallow", "crawl_delay"), F.col("group_no"))).alias("groups"),
        F.count_if(F.col("kind").isin("rule_allow", "rule_disallow")).alias("rules"),
        F.countDistinct(F.when(F.col("kind") == "sitemap", F.col("value"))).alias("sitemaps"),
    )
    return counts.join(crawl_delays(parsed, ""), "host", "left")
