"""Discovery over a simulated site, and mail."""

from pyspark.sql import functions as F

from docsift.operators import frontier, robots
from docsift.plans.queries import store
from docsift.sources import mail

SITE = {
    "https://www.h.org/": (200, '<a href="/policies">Medical policies</a><a href="/careers">Jobs</a><a href="https://other.net/x.pdf">Elsewhere</a>'),
    "https://www.h.org/policies": (200, '<a href="/docs/a.pdf">Medical policy A</a><a href="/docs/b.pdf">B</a><a href="/private/c.pdf">C</a><a href="/docs/gone.pdf">Gone</a><a href="/docs/wall.pdf">Wall</a><a href="/docs/A.pdf#x">A again</a>'),
    "https://www.h.org/docs/a.pdf": (200, "%PDF-1"),
    "https://www.h.org/docs/A.pdf": (200, "%PDF-2"),
    "https://www.h.org/docs/b.pdf": (200, "%PDF-3"),
    "https://www.h.org/private/c.pdf": (200, "%PDF-4"),
    "https://www.h.org/docs/wall.pdf": (403, "no"),
}


def site(spark):
    rows = [(u, s, {"content-type": "text/html"}, b.encode(), u) for u, (s, b) in SITE.items()]
    return spark.createDataFrame(rows, "url string, status int, headers map<string,string>, content binary, final_url string")


def payers(spark):
    return spark.createDataFrame([("P", "www.h.org", 1, [], [])], "payer_name string, hint_host string, position int, extra_hosts array<string>, seed_paths array<string>")


def rules(spark):
    return store(robots.rules_for(robots.parse_robots(spark.createDataFrame([("www.h.org", "User-agent: *\nDisallow: /private/\n")], "host string, text string")), "docsift"))


def test_discovery(spark):
    found = {r["url"]: (r["outcome"], r["file_type"]) for r in frontier.discover(payers(spark), site(spark), rules(spark), store).collect()}
    assert found == {
        "https://www.h.org/docs/a.pdf": ("ok", "pdf"),
        "https://www.h.org/docs/A.pdf": ("ok", "pdf"),
        "https://www.h.org/docs/b.pdf": ("ok", "pdf"),
        "https://www.h.org/private/c.pdf": ("robots", "pdf"),
        "https://www.h.org/docs/gone.pdf": ("failed", "pdf"),
        "https://www.h.org/docs/wall.pdf": ("challenged", "html"),
    }
    out = frontier.discover(payers(spark), site(spark), rules(spark), store)
    assert frontier.blocks(out).first()["block_evidence"] == "http_403"
    path = out.where(F.col("url").endswith("/a.pdf")).first()["discovery_path"]
    assert path == "home > index:/ > index:/policies > anchor[href$='.pdf'] 'Medical policy A'"


def test_budgets(spark):
    assert frontier.discover(payers(spark), site(spark), rules(spark), store, max_docs=2).count() == 2
    entries = spark.createDataFrame([("P", "https://www.h.org/docs/b.pdf", "2026"), ("P", "https://www.h.org/careers/x", ""), ("P", "https://off.net/y.pdf", "")], "payer string, loc string, lastmod string")
    seeds = frontier.seed_candidates(payers(spark), entries).collect()
    assert sorted((r["origin"], r["priority"]) for r in seeds) == [("index", 0.5), ("sitemap_doc", 3.2)]


def test_enumeration(spark):
    found = spark.createDataFrame([("P", f"https://www.h.org/d/{n}.pdf", n) for n in (10, 11, 13)], "payer_name string, document_url string, seq long")
    answers = [(f"https://www.h.org/d/{n}.pdf", 403 if n == 17 else 200, {"content-type": ""}, b"%PDF-", "") for n in (12, 14, 15, 16, 17, 9)]
    responses = spark.createDataFrame(answers, "url string, status int, headers map<string,string>, content binary, final_url string")
    withheld = spark.createDataFrame([("P",)], "payer_name string")
    got = {r["url"].rsplit("/", 1)[1]: r["outcome"] for r in frontier.enumerate_documents(found, withheld, responses, rules(spark)).collect()}
    assert got == {"14.pdf": "ok", "15.pdf": "ok", "16.pdf": "ok", "17.pdf": "challenged"}
    assert frontier.enumerate_documents(found, withheld.limit(0), responses, rules(spark)).count() == 0


def test_mail(tmp_path):
    path = tmp_path / "o.csv"
    path.write_text("a,b\n")
    sent = []
    assert mail.send_output(True, "x@y", [str(path), "missing"], "s", "b", sent.append) == (True, "")
    assert [a.get_filename() for a in sent[0].iter_attachments()] == ["o.csv"]
    assert mail.send_output(False, "x@y", [], "s", "b", sent.append)[0] is False

    def broken(m):
        raise OSError("login hunter2 failed password=abc")

    assert mail.send_output(True, "x@y", [], "s", "b", broken, secrets=["hunter2"]) == (False, "OSError: login *** failed password=***")
