"""Rows, deduplication, robots, sitemaps, enumeration, pacing, checkpoint, sinks, streaming, fetching, configuration."""

import gzip
import random
import xml.dom.minidom
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from docsift import config
from docsift.functions import vocab
from docsift.operators import components, dedupe, enumeration, html, pacing, report, robots, rows, sitemap
from docsift.plans.queries import store
from docsift.sources import fetch, seeds, sinks
from docsift.sources.checkpoint import Checkpoint
from docsift.streaming import twins

GOOD = dict(
    payer_name="Acme", payer_alias="A", state_or_region="PA", line_of_business="Medicare", document_title="Bariatric Surgery", document_type="medical_policy", document_url="https://a.example.com/x.pdf",
    source_page_url="", discovery_path="sitemap", file_type="pdf", policy_number="", effective_date="2026-01-01", last_updated_date="", http_status="200", content_hash_sha256="a" * 64, file_size_bytes="10",
    requires_auth="N", render_mode="static", extraction_method="sitemap", confidence_score="0.90", scrape_timestamp_utc="2026-01-01T00:00:00Z", notes="",
)


def catalogue(spark, *changes):
    return spark.createDataFrame([tuple({**GOOD, **c}[n] for n in vocab.COLUMNS) + (k,) for k, c in enumerate(changes)], ", ".join(f"{n} string" for n in vocab.COLUMNS) + ", seq long")


def problems(spark, **change):
    return rows.validate_rows(catalogue(spark, change)).first()["problems"]


def test_validation(spark):
    assert problems(spark) == []
    assert problems(spark, payer_name="") == ["payer_name is required"]
    assert problems(spark, content_hash_sha256="") == ["content_hash_sha256 is required for a 200 response"]
    assert problems(spark, http_status="404") == ["content_hash_sha256 must be empty when http_status != 200 or requires_auth=Y"]
    assert problems(spark, confidence_score="0.40") == ["confidence_score 0.40 < 0.70 requires an explanation in notes"]
    assert len(problems(spark, document_type="x", extraction_method="a|regex", policy_number="TBD")) == 3
    with pytest.raises(Exception, match="payer_name is required"):
        rows.validate_rows(catalogue(spark, {"payer_name": ""}), strict=True).collect()


def test_normalising_again_changes_nothing(spark):
    once = rows.normalise_rows(catalogue(spark, {"state_or_region": "PA|ZZ", "effective_date": "March 1, 2026", "http_status": "x", "document_url": " https://h/a b "}))
    assert once.collect() == rows.normalise_rows(once).collect()
    assert once.first()["document_url"] == "https://h/a%20b" and once.first()["content_hash_sha256"] == ""


def fetched(spark, **change):
    base = dict(
        payer_name="Acme", payer_alias="A", default_state_or_region="PA", default_line_of_business="Medicare", url="https://h.example/p/medical-policy.html", source_page_url="s", discovery_path="d", origin="anchor", link_text="",
        status=200, content=b"<html><h1>Medical Policy Imaging</h1><p>Policy number: MP-042. Effective date: 03/01/2026</p>", final_url="https://h.example/p/medical-policy.html", truncated=False, file_type="html", requires_auth=False, note="", fetched_at="2026-01-01T00:00:00Z",
    )
    base.update(change)
    kinds = {"status": "int", "content": "binary", "truncated": "boolean", "requires_auth": "boolean"}
    return rows.build_rows(spark.createDataFrame([tuple(base.values())], ", ".join(f"{k} {kinds.get(k, 'string')}" for k in base))).first()


def test_built_rows(spark):
    r = fetched(spark)
    assert (r["document_title"], r["policy_number"], r["effective_date"], r["document_type"], r["confidence_score"], r["extraction_method"], r["notes"]) == ("Medical Policy Imaging", "MP-042", "2026-03-01", "medical_policy", "1.00", "css_selector|regex", "")
    r = fetched(spark, status=404)
    assert (r["confidence_score"], r["content_hash_sha256"], r["http_status"]) == ("0.25", "", "404") and "http_status 404" in r["notes"]
    r = fetched(spark, requires_auth=True, link_text="Gated form")
    assert (r["requires_auth"], r["confidence_score"], r["document_title"]) == ("Y", "0.40", "Gated form")
    r = fetched(spark, file_type="docx", content=b"PK\x03\x04", origin="url_pattern", final_url="https://h.example/z")
    assert "not parsed" in r["notes"] and r["notes"].endswith("redirected to https://h.example/z")


def model(items):
    """Deduplication in plain Python, for the test: (kept seqs, components)."""
    parent = {i["seq"]: i["seq"] for i in items}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seen = {}
    for i in items:
        for key in i["keys"]:
            if key in seen:
                a, b = sorted((find(seen[key]), find(i["seq"])))
                parent[b] = a
            else:
                seen[key] = i["seq"]
    return {i["seq"]: find(i["seq"]) for i in items}


def test_components_match_a_union_find(spark):
    rng = random.Random(3)
    items = [{"seq": k, "keys": [("h", rng.randrange(60)), ("t", rng.randrange(60))] if k % 3 else [("h", 100 + k)]} for k in range(80)]
    expected = model(items)
    edges, first = [], {}
    for i in items:
        for key in i["keys"]:
            edges.append((i["seq"], first.setdefault(key, i["seq"])))
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "src long, dst long"), store).collect()}
    assert {k: got.get(k, k) for k in expected} == expected
    assert components.connected_components(spark.createDataFrame([], "src long, dst long"), store).count() == 0


def test_transitive_merge_and_winner(spark):
    df = catalogue(
        spark,
        {"document_url": "https://a.example.com/1.pdf", "content_hash_sha256": "b" * 64, "document_title": "Alpha Beta"},
        {"document_url": "https://a.example.com/2.pdf", "content_hash_sha256": "b" * 64, "document_title": "Gamma Delta", "effective_date": "2026-05-01"},
        {"document_url": "https://a.example.com/3.pdf", "content_hash_sha256": "c" * 64, "document_title": "Gamma Delta"},
        {"document_url": "https://A.example.com/3.pdf#x", "content_hash_sha256": "d" * 64, "document_title": "Other Thing"},
        {"document_url": "https://a.example.com/9.pdf", "payer_name": "Else", "content_hash_sha256": "b" * 64, "document_title": "Zeta Eta"},
    )
    kept = {r["seq"]: r for r in dedupe.dedupe(df, store).collect()}
    assert sorted(kept) == [1, 4] and kept[1]["n_dropped"] == 2 and kept[1]["tier"] == "content_hash"
    assert kept[1]["notes"].startswith("collapsed 2 near-duplicate URL(s) under the 'content_hash' rule (e.g. https://a.example.com/1.pdf)")
    assert {(r["kind"], r["name"]): r["n"] for r in dedupe.dedupe_report(dedupe.dedupe(df, store)).collect()} == {("tier", "exact_url"): 1, ("tier", "content_hash"): 2, ("payer", "Acme"): 3, ("collapsed", ""): 3, ("kept", ""): 2}
    assert dedupe.dedupe(df.limit(0), store).count() == 0 and "canonical" in dedupe.rule_description()


def test_robots(spark):
    text = "﻿User-agent: *\nDisallow: /private\nAllow: /private/ok\nDisallow:\n\nUser-agent: bot\nUser-agent: docsift\nSitemap: https://h/s.xml\nUser-agent: third\nDisallow: /b*.pdf$\nCrawl-delay: x\nCrawl-delay: 5\nnonsense\n"
    parsed = store(robots.parse_robots(spark.createDataFrame([("h", text)], "host string, text string")))
    assert robots.choose_group(parsed, "other").first()["group_no"] == 1 and robots.choose_group(parsed, "DocSift/1").first()["group_no"] == 2
    ask = lambda agent, *paths: [
        (r["allowed"], r["matched_rule"]) for r in robots.decide(spark.createDataFrame([(k, f"https://h{p}") for k, p in enumerate(paths)], "k int, url string"), robots.rules_for(parsed, agent), keys=("k",)).orderBy("k").collect()
    ]
    assert ask("x", "/private", "/PRIVATE/ok/1", "/") == [(False, "Disallow: /private"), (True, "Allow: /private/ok"), (True, "")]
    assert ask("docsift", "/b/x.pdf", "/b/x.pdf?1", "/private") == [(False, "Disallow: /b*.pdf$"), (True, ""), (True, "")]
    assert robots.crawl_delays(parsed, "docsift").first()["crawl_delay"] == 5.0
    assert robots.sitemaps(parsed).first()["url"] == "https://h/s.xml"
    assert [r["value"] for r in parsed.where("kind = 'unknown'").orderBy("line").collect()] == ["Crawl-delay: x", "nonsense"]


def test_sitemaps(spark):
    text = "<sitemapindex><sitemap><loc>http://a/1 </loc><lastmod>2026</lastmod></sitemap><sitemap><loc><![CDATA[http://a/2]]></loc></sitemap><loc>http://a/3</loc><loc>http://a/1</loc><url><loc>ftp://x</loc>"
    got = [(r["is_index"], r["loc"], r["lastmod"]) for r in sitemap.parse_sitemaps(spark.createDataFrame([(text,)], "text string")).orderBy("seq").collect()]
    assert got == [(True, "http://a/1", "2026"), (True, "http://a/2", ""), (True, "http://a/3", "")]
    packed = spark.createDataFrame([(gzip.compress(text.encode()),), (b"\x1f\x8bbroken",), (b"caf\xe9",)], "content binary")
    assert [r["text"][:4] for r in sitemap.unpacked(packed).collect()][::2] == ["<sit", "café"]
    index = "<sitemapindex><sitemap><loc>http://h/b.xml</loc></sitemap><sitemap><loc>http://h/a.xml</loc></sitemap></sitemapindex>"
    page = "<urlset><url><loc>http://h/p1</loc></url></urlset>"
    responses = spark.createDataFrame([("http://h/a.xml", index), ("http://h/b.xml", page)], "url string, text string")
    starts = spark.createDataFrame([("P", "http://h/a.xml", 0)], "payer string, url string, seq long")
    assert [r["loc"] for r in sitemap.walk(starts, responses, store).collect()] == ["http://h/p1"]


def test_links(spark):
    page = '<a href="/x.pdf">One <b>more</b></a><a href=../y#f title="T"></a><a href="mailto:z">m</a><a href="/x.pdf">again</a>'
    df = spark.createDataFrame([("https://h.org/a/b/c", page)], "url string, html string")
    assert [(r["link"], r["text"]) for r in html.extract_links(df).orderBy("seq").collect()] == [("https://h.org/x.pdf", "One more"), ("https://h.org/a/y", "T")]
    assert [(r["href"], r["text"]) for r in html.parsed_links(df).orderBy("seq").collect()][:2] == [("/x.pdf", "One more"), ("../y#f", "T")]


def test_links_beside_anchors(spark):
    page = '<!-- <a href="/no">n</a> --><a href="/i?a=1&amp;b=2"><img src=q alt="Img"></a><object data="//o.org/d"></object><embed src=/e><iframe title="F" src="/f"></iframe><iframe></iframe><embed src="/f">'
    df = spark.createDataFrame([("https://h.org/a", page), ("https://h.org/b", None)], "url string, html string")
    found = [(r["seq"], r["link"], r["text"]) for r in html.extract_links(df).orderBy("seq").collect()]
    assert found == [(0, "https://h.org/i?a=1&b=2", "Img"), (1, "https://h.org/f", "F"), (3, "https://h.org/e", ""), (5, "https://o.org/d", "")]


def test_titles(spark):
    cases = [
        ("<h1>A &amp; <b>B</b> title</h1><title>x</title>", "A & B title"),
        ("<h1>ab</h1><meta content='Og > one' property=\"og:title\"><title>x</title>", "Og > one"),
        ("<h1>" + "x" * 301 + '</h1><META NAME="dc.title" content=Plain><title>x</title>', "Plain"),
        ('<meta property="og:title" content="ab"><meta name="title" content="Other one"><title>Named page</title>', "Named page"),
        ("<!-- <h1>commented</h1> --><script>'<h1>scripted</h1>'</script>", ""),
        ("", ""),
        (None, ""),
    ]
    df = spark.createDataFrame([(k, p) for k, (p, _) in enumerate(cases)], "k int, p string")
    got = [r["t"] for r in df.select("k", html.html_title(df["p"]).alias("t")).orderBy("k").collect()]
    assert [tuple(t) for t in got] == [(t, "css_selector" if t else "") for _, t in cases]


def test_templates(spark):
    found = [("P", k, f"https://h/p/{n}.pdf") for k, n in enumerate((10, 11, 14))] + [("P", 9, "https://h/q/77.pdf"), ("Q", 1, "https://h/p/10.pdf")]
    t = enumeration.templates(spark.createDataFrame(found, "payer_name string, seq long, document_url string"))
    assert [(r["payer_name"], r["prefix"], r["suffix"], [int(n) for n in r["numbers"]]) for r in t.collect()] == [("P", "https://h/p/", ".pdf", [10, 11, 14])]
    assert [r["number"] for r in enumeration.candidates(t, 20).orderBy("place").collect()] == [15, 16, 17, 18, 6, 7, 8, 9, 12, 13]


def tried_numbers(numbers, budget):
    """What the crawler tries, number by number; gaps are searched no farther than the budget goes."""
    low, high = numbers[0], numbers[-1]
    span = max(4, min(budget // 2, (high - low) or 8))
    wanted = [*range(high + 1, high + 1 + span), *range(max(1, low - span), low)]
    for a, b in zip(numbers, numbers[1:]):
        wanted += range(a + 1, min(b, a + 1 + budget))
    return wanted[:budget]


def test_candidates_of_wide_and_many_numbers(spark):
    cases = {"wide": [2, 3, 5_000_000_000_000], "long": [10**24, 10**24 + 1, 10**24 + 3], "zero": [0, 12, 40, 42], "near": [3, 20, 21, 25], "many": list(range(2, 200_000, 2)), "full": list(range(50, 60)), "three": [1, 2, 4]}
    found = spark.createDataFrame([(name, f"https://h/{name}/", ".pdf", [Decimal(n) for n in numbers]) for name, numbers in cases.items()], "payer_name string, prefix string, suffix string, numbers array<decimal(38,0)>")
    for budget in (0, 1, 7, 20):
        got = {name: [] for name in cases}
        for r in sorted(enumeration.candidates(found, budget).select("payer_name", "place", "number", "url").collect()):
            assert r["place"] == len(got[r["payer_name"]]) and r["url"] == f"https://h/{r['payer_name']}/{r['number']}.pdf"
            got[r["payer_name"]].append(int(r["number"]))
        assert got == {name: tried_numbers(numbers, budget) for name, numbers in cases.items()}


def test_bucket_and_streaks(spark):
    bucket = pacing.Bucket(1.0)
    assert [round(bucket.acquire(t), 3) for t in (0, 0, 0, 5)] == [0, 1, 2, 5]
    bucket.slow_to(4)
    assert [round(bucket.acquire(t), 3) for t in (10, 10)] == [10, 14]
    df = spark.createDataFrame([("h", k, s) for k, s in enumerate("xxoxxxo")], "host string, ts long, s string")
    assert [r["streak"] for r in pacing.failure_streaks(df, F.col("s") == "x").orderBy("ts").collect()] == [1, 2, 0, 1, 2, 3, 0]
    assert pacing.write_offs(df, F.col("s") == "x", limit=3).first()["written_off"]
    arrivals = spark.createDataFrame([("h", k, 0.0) for k in range(3)], "host string, request_id long, arrival_s double")
    assert sorted(r["admitted_s"] for r in pacing.admit(arrivals, 1.0).collect()) == [0.0, 1.0, 2.0]


def test_checkpoint(spark, tmp_path):
    c = Checkpoint(spark, str(tmp_path / "cp"))
    c.start_run("r1", "t0")
    c.finish_run("r1", "t1")
    assert c.runs().first()["finished_at"] == "t1" and c.payer_status("Acme") == "pending"
    c.mark_payer("Acme", status="in_progress", stats_json='{"found": 4}')
    c.mark_payer("Acme", status="done", attempted=3, stats_json='{"found": 4, "attempted": 1}')
    stats = c.payer_stats().first()
    assert (c.payer_status("Acme"), stats["attempted"], stats["found"]) == ("done", 3, 4)
    assert c.open_payers(spark.createDataFrame([("Acme",), ("Other",)], "payer_name string")).first()["payer_name"] == "Other"
    df = catalogue(spark, {}, {"document_url": "https://A.example.com/x.pdf#f"}, {"document_url": "https://a.example.com/y.pdf", "payer_name": "B"})
    assert c.save_rows(df, "r1", "t") == 2 and c.save_rows(df, "r1", "t") == 0 and c.row_count() == 2
    assert [r["payer_name"] for r in c.load_rows("B").collect()] == ["B"] and len(c.load_rows().collect()) == 2
    assert c.has_row(spark.createDataFrame([("https://a.example.com/y.pdf?utm_a=1",), ("https://no/",)], "url string")).count() == 1
    c.mark_visited(spark.createDataFrame([("https://v/",)], "url string"), "Acme", "index", "t")
    c.mark_visited(spark.createDataFrame([("https://v/#x",)], "url string"), "Acme", "index", "t")
    assert c.visited_urls("Acme").count() == 1 and "1 payer(s) finished" in c.resume_banner()
    assert Checkpoint(spark, str(tmp_path / "cp"), reset=True).row_count() == 0


def test_sinks(spark, tmp_path):
    df = catalogue(spark, {"document_title": 'A "quoted", title', "notes": "x"}, {"document_url": "https://a/2"}).drop("seq")
    body = open(sinks.write_csv(df, str(tmp_path / "o.csv")), "rb").read()
    assert body.startswith(b"payer_name,payer_alias") and body.count(b"\r\n") == 3 and b'"A ""quoted"", title"' in body and b'""' not in body.replace(b'""quoted""', b"")
    empty = open(sinks.write_csv(df.limit(0), str(tmp_path / "e.csv")), "rb").read()
    assert empty.strip().split(b",")[-1] == b"notes"
    with zipfile.ZipFile(sinks.write_xlsx(df, str(tmp_path / "o.xlsx"))) as z:
        for name in z.namelist():
            xml.dom.minidom.parseString(z.read(name))
        assert b"policy_documents" in z.read("xl/workbook.xml") and z.read("xl/worksheets/sheet1.xml").count(b"<row ") == 3
    with pytest.raises(ValueError):
        sinks.write_csv(df.withColumn("more", F.lit(1)), str(tmp_path / "x.csv"))
    bad = rows.validate_rows(catalogue(spark, {"payer_name": ""}))
    assert sinks.validation_report(bad).first()["value"] == "https://a.example.com/x.pdf\n    - payer_name is required"
    docs = spark.createDataFrame([("P One", "https://h/a/doc.pdf", "f" * 64, "pdf", b"body")], "payer_name string, url string, digest string, file_type string, content binary")
    assert [tuple(r) for r in sinks.archive(docs, str(tmp_path / "arch")).collect()] == [("P_One/doc_ffffffffff.pdf", True)]
    assert not sinks.archive(docs, str(tmp_path / "arch")).first()["written"]
    events = spark.sql("SELECT timestamp'2026-01-01 00:00:00' AS ts, 'INFO' AS lvl, 'run.start' AS event, cast(null as string) AS payer, 3 AS n")
    assert sinks.event_lines(events, "r", ("payer", "n")).first()["value"] == '{"ts":"2026-01-01T00:00:00.000Z","lvl":"INFO","event":"run.start","n":3,"run_id":"r"}'


def test_reports(spark):
    stats = spark.createDataFrame([("A", 3, 2, 1, 0, 0), ("B", 0, 0, 0, 4, 0)], "payer_name string, attempted long, found long, failed long, skipped_robots long, dupes_collapsed long")
    assert {r["payer_name"]: r["attempted"] for r in report.with_totals(stats).collect()} == {"A": 3, "B": 0, "TOTAL": 3}
    payers = spark.createDataFrame([("B", 1), ("C", 2)], "payer_name string, position int")
    ordered = report.in_seed_order(payers, stats).withColumns({"blocked": F.lit(False), "status": F.lit("done"), "elapsed_s": F.lit(1.25)})
    ordered = ordered.fillna(0, list(report.MEASURES)).withColumn("outcome", report.verdict())
    lines = [r["line"] for r in ordered.select(report.summary_line().alias("line")).collect()]
    assert len(lines) == 3 and "robots-disallowed" in lines[0] and lines[2].endswith("ok")


def test_seeds(spark, tmp_path):
    path = tmp_path / "seeds.csv"
    path.write_text("﻿Payer Name,Website,LOB,Seed-Paths,Extra\nAcme,https://www.acme.com/x,Medicare,/a|/b,z\n,,,,\nBad,nodot,Wrong,,\n", encoding="utf-8")
    payers = seeds.load_payers(spark, str(path))
    first = payers.orderBy("position").first()
    assert (first["payer_name"], first["hint_host"], first["seed_paths"], first["position"]) == ("Acme", "www.acme.com", ["/a", "/b"], 1)
    with pytest.raises(ValueError, match="nodot.*Wrong"):
        seeds.checked(payers)
    assert seeds.select_payers(payers, "2").first()["payer_name"] == "Bad"


class Clock:
    def __init__(self):
        self.now = 0.0

    def __call__(self):
        return self.now

    def sleep(self, s):
        self.now += s


def test_client():
    clock, calls = Clock(), []

    def opener(url, method, headers, timeout, limit):
        calls.append((url, method))
        if "down" in url:
            raise OSError("no route")
        if "busy" in url and len([c for c in calls if c[0] == url]) == 1:
            return 429, url, {"retry-after": "7"}, b"", False
        return (405 if method == "HEAD" else 200), url, {}, b"body", False

    client = fetch.Client(rate=1.0, retries=1, base=1.0, opener=opener, clock=clock, sleep=clock.sleep, seed=1)
    assert client.get("http://h/a", "h")["status"] == 200 and client.get("http://h/a", "h")["from_cache"]
    got = client.get("http://h/busy", "h")
    assert (got["status"], got["attempts"]) == (200, 2) and clock.now >= 7 and client.buckets["h"].rate < 1
    assert client.head_or_get("http://h/z", "h")["status"] == 200
    for _ in range(8):
        assert client.get("http://down/x", "down")["status"] == 0
    assert client.get("http://down/x", "down")["error"] == "host written off"


def test_replay(spark):
    responses = spark.createDataFrame([("http://h/a?utm_x=1", 200)], "url string, status int")
    got = fetch.replay(spark.createDataFrame([("http://h/a",), ("http://h/b",)], "url string"), responses)
    assert {r["url"]: r["status"] for r in got.collect()} == {"http://h/a": 200, "http://h/b": 0}


def test_streams(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("h", k, "x" if k % 4 else "o") for k in range(10)], "host string, seq long, s string").coalesce(1).write.parquet(source)
    stream = spark.readStream.schema("host string, seq long, s string").parquet(source)
    q = twins.host_failures(stream, F.col("s") == "x", limit=3).writeStream.outputMode("update").format("memory").queryName("off").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [tuple(r) for r in spark.sql("SELECT * FROM off").collect()] == [("h", 1, True)]
    sink = twins.new_rows_sink(str(tmp_path / "rows"), "host")
    batch = spark.read.parquet(source)
    sink(batch, 0)
    sink(batch, 0)
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 1


def test_config(tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"crawl": {"max_docs_per_payer": 7, "retry_limit": "1"}}')
    c = config.build(config.load_file(str(path)), {"crawl": {"max_docs_per_payer": "9"}, "output": {"also_xlsx": "yes"}})
    assert (c.crawl.max_docs_per_payer, c.crawl.retry_limit, c.output.also_xlsx) == (9, 1, True)
    with pytest.raises(ValueError, match="nothing.*crawl.bad.*retry_limit"):
        config.build({"nothing": {}, "crawl": {"bad": 1, "retry_limit": -1}})
    assert len(config.new_run_id().split("-")[1]) == 6
    assert [config.exit_code(*x) for x in ((True, False, 1), (False, True, 1), (False, False, 0), (False, False, 2))] == [130, 1, 2, 0]


def test_robots_default_by_answer(spark):
    from docsift.operators import robots

    answers = [("https://a.org/robots.txt", 200, b"User-agent: *\nDisallow: /x"), ("https://b.org/robots.txt", 404, b""), ("https://c.org/robots.txt", 403, b"no"), ("https://d.org/robots.txt", 503, b""), ("https://e.org/robots.txt", 0, b""), ("https://f.org/robots.txt", 401, b""), ("https://p.org/robots.txt", 200, b"<html>Disallow: /x</html>")]
    responses = spark.createDataFrame(answers, "url string, status int, content binary")
    policies = robots.policies_of(responses)
    rules = robots.rules_for(robots.parse_robots(responses.selectExpr("regexp_extract(url, '//([^/]*)', 1) AS host", "cast(content AS string) AS text")), "docsift/0.1")
    urls = spark.createDataFrame([(f"https://{h}.org{p}",) for h in "abcdefpz" for p in ("/x", "/y")], "url string")
    got = {r["url"]: r["allowed"] for r in robots.decide(urls, rules, policies=policies).collect()}
    assert {u.removeprefix("https://") for u, ok in got.items() if ok} == {"a.org/y", "b.org/x", "b.org/y", "p.org/x", "p.org/y"}
    assert all(r["reason"] for r in robots.decide(urls, rules, policies=policies).where("not allowed").collect())


def test_document_budget_counts_what_is_found(spark):
    from docsift.operators import frontier

    rows = [("A", k, f"k{k}", k != 1) for k in range(6)]
    candidates = spark.createDataFrame(rows, "payer_name string, place int, key string, allowed boolean")
    answered = spark.createDataFrame([(f"k{k}", 200 if k != 0 else 404, b"x") for k in range(6)], "key string, status int, content binary")
    assert [r["place"] for r in frontier.within_budget(candidates, 2, answered).orderBy("place").collect()] == [0, 1, 2, 3]
