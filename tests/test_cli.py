"""The command line end to end over stored responses, and a second run that resumes."""

import csv

from docsift import cli
from docsift.sources.checkpoint import Checkpoint
from tests.test_discovery import SITE


def test_run_and_resume(spark, tmp_path):
    seeds = tmp_path / "seeds.csv"
    seeds.write_text("payer_name,hint_host\nP,www.h.org\nQ,refused.org\n")
    robots = [("https://www.h.org/robots.txt", 200, "User-agent: *\nDisallow: /private/\n"), ("https://refused.org/robots.txt", 403, "no")]
    pages = [(u, s, b) for u, (s, b) in SITE.items()] + robots + [("https://refused.org/", 200, '<a href="/medical-policy.pdf">Medical policy</a>'), ("https://refused.org/medical-policy.pdf", 200, "%PDF-9")]
    rows = [(u, s, {"content-type": "text/html"}, b.encode(), u, False) for u, s, b in pages]
    responses = str(tmp_path / "responses")
    spark.createDataFrame(rows, "url string, status int, headers map<string,string>, content binary, final_url string, truncated boolean").write.parquet(responses)
    args = ["--payer-csv", str(seeds), "--responses", responses, "--state-path", str(tmp_path / "state"), "--output-dir", str(tmp_path / "out")]

    def run():
        cli.main(args)
        with open(tmp_path / "out" / "output.csv", newline="") as f:
            return sorted(r["document_url"] for r in csv.DictReader(f))

    first = run()
    assert "https://www.h.org/docs/b.pdf" in first and not any("private" in u or "refused.org" in u for u in first)
    state = Checkpoint(spark, str(tmp_path / "state" / "tables"))
    stats = {r["payer_name"]: r for r in state.payers().collect()}
    assert stats["P"]["status"] == "done" and stats["P"]["found"] >= 2 and stats["P"]["skipped_robots"] == 1
    assert stats["Q"]["status"] == "done" and (stats["Q"]["found"], stats["Q"]["attempted"]) == (0, 0)
    assert state.visited_urls("P").count() >= 3 and state.open_payers(spark.createDataFrame([("P",), ("Z",)], "payer_name string")).count() == 1
    assert run() == first
