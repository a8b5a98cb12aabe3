"""Command line: list payers, or run discovery over stored responses to a deduplicated catalogue."""

from __future__ import annotations

import argparse
import os
import sys
from datetime import datetime, timezone

from pyspark.sql import functions as F

from docsift import config as settings
from docsift.operators.dedupe import dedupe
from docsift.functions.urls import host
from docsift.operators.frontier import blocks, discover
from docsift.operators.report import counters, payer_status
from docsift.operators.robots import parse_robots, policies_of, rules_for
from docsift.operators.rows import build_rows, prepare_rows
from docsift.session import session
from docsift.sources.checkpoint import Checkpoint
from docsift.sources.seeds import checked, listing, load_payers, select_payers
from docsift.sources.sinks import validation_report, write_output


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="docsift")
    out.add_argument("--config")
    out.add_argument("--list-payers", action="store_true")
    out.add_argument("--responses", help="Parquet of stored responses (url, final_url, status, headers, content, truncated)")
    sections = settings.Config().to_dict()
    names = [name for part in sections.values() for name in part]
    for section, part in sections.items():
        for name in part:  # a name that several sections have comes with its section's
            said = name if names.count(name) == 1 and name != "config" else f"{section}_{name}"
            out.add_argument(f"--{said.replace('_', '-')}", dest=f"{section}.{name}")
    return out


def main(argv: list[str] | None = None) -> int:
    args = vars(parser().parse_args(argv))
    overrides: dict[str, dict] = {}
    for name, value in args.items():
        if "." in name and value is not None:
            section, key = name.split(".")
            overrides.setdefault(section, {})[key] = value
    conf = settings.build(settings.load_file(args["config"]), overrides)
    spark = session("docsift-cli")
    payers = select_payers(checked(load_payers(spark, conf.crawl.payer_csv)), conf.crawl.payer_range)
    if args["list_payers"]:
        for r in payers.orderBy("position").select(listing().alias("line")).toLocalIterator():
            print(r["line"])
        return 0
    if not args["responses"]:
        print("give --responses", file=sys.stderr)
        return 2
    spark.sparkContext.setCheckpointDir(os.path.join(conf.resume.state_path, "waves"))
    store = lambda df: df.checkpoint()
    responses = spark.read.parquet(args["responses"])
    state = Checkpoint(spark, os.path.join(conf.resume.state_path, "tables"), reset=conf.resume.reset)
    run_id, now = settings.new_run_id(), datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    state.start_run(run_id, now)
    answers = responses.where(F.col("url").endswith("/robots.txt"))
    policies = store(policies_of(answers))
    robots = answers.where(F.col("status") == 200).select(host(F.col("url")).alias("host"), F.col("content").cast("string").alias("text"))
    parsed = store(parse_robots(robots))
    rules = store(rules_for(parsed, conf.crawl.user_agent))
    open_payers = store(state.open_payers(payers))
    documents = store(discover(open_payers, responses, rules, store, index_pages=conf.crawl.max_index_pages, max_docs=conf.crawl.max_docs_per_payer, policies=policies))
    wanted = documents.where(~F.col("outcome").isin("robots", "unrecognised", "duplicate"))
    gated = F.col("outcome").isin("gated") | ((F.col("outcome") == "challenged") & F.col("status").isin(401, 403))
    made = wanted.join(open_payers.select("payer_name", "payer_alias", "default_state_or_region", "default_line_of_business"), "payer_name").withColumns({"requires_auth": gated, "note": F.col("evidence"), "fetched_at": F.lit(now), "truncated": F.coalesce("truncated", F.lit(False))})
    rows = build_rows(made.repartitionByRange("payer_name", "place").sortWithinPartitions("payer_name", "place")).withColumn("seq", F.monotonically_increasing_id())
    state.save_rows(store(rows), run_id, now)
    stats = counters(documents).join(blocks(documents).select("payer_name", "block_evidence"), "payer_name", "left")
    marked = open_payers.select("payer_name").join(stats, "payer_name", "left").fillna(0).fillna(False)
    for r in marked.withColumn("status", payer_status(F.col("blocked"), F.col("found"))).toLocalIterator():  # a row a payer of the seed list
        state.mark_payer(r["payer_name"], status=r["status"], run_id=run_id, attempted=r["attempted"], found=r["found"], failed=r["failed"], skipped_robots=r["skipped_robots"], blocked=r["blocked"], block_evidence=r["block_evidence"] or "", updated_at=now)
        state.mark_visited(documents.where(F.col("payer_name") == r["payer_name"]), r["payer_name"], "document", now)
    final = prepare_rows(dedupe(state.load_rows(), store))
    os.makedirs(conf.output.output_dir, exist_ok=True)
    kept = store(final.orderBy("seq"))
    write_output(kept.select(*kept.columns[:22]), conf.output.output_dir, conf.output.output_format, conf.output.also_xlsx)
    bad = validation_report(kept)
    n_bad = bad.count()
    if n_bad:
        bad.select("value").coalesce(1).write.mode("overwrite").text(os.path.join(conf.output.output_dir, "validation"))
    state.finish_run(run_id, datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"))
    return settings.exit_code(False, conf.output.strict_schema and n_bad > 0, kept.count())


if __name__ == "__main__":
    sys.exit(main())
