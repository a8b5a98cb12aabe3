"""The seed list: a CSV with header aliases, row checks that are collected, and range selection."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsift.functions import vocab
from docsift.functions.text import clean_text, normalise_multi_enum, split_list
from docsift.functions.urls import host


def canonical_header(raw: str) -> str:
    squashed = re.sub(r"[\W_]", "", raw.lower())
    for name, aliases in vocab.HEADER_ALIASES.items():
        if squashed in aliases:
            return name
    return raw.strip().lower().replace(" ", "_").replace("-", "_")


def normalise_host(c: Column) -> Column:
    text = F.regexp_replace(clean_text(c), "^/+|/+$", "")
    name = F.when(F.contains(text, F.lit("://")), F.when(host(text) == "", text).otherwise(host(text))).otherwise(F.substring_index(text, "/", 1))
    return F.regexp_replace(F.regexp_replace(F.lower(name), "^@+", ""), r"^\.+|\.+$", "")


def load_payers(spark: SparkSession, path: str) -> DataFrame:
    """Payers with position (from 1, in file order) and errors (array); blank lines and unknown columns are ignored."""
    raw = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True, encoding="UTF-8", mode="PERMISSIVE", enforceSchema=True)
    names = {}
    for c in raw.columns:
        names.setdefault(canonical_header(c.lstrip("﻿")), c)
    missing = [n for n in ("payer_name", "hint_host") if n not in names]
    if missing:
        raise ValueError(f"the seed list lacks the column(s) {', '.join(missing)}")
    value = lambda n: F.col(f"`{names[n]}`") if n in names else F.lit("")
    # a seed list is one small file: one partition keeps its order
    ordered = raw.where(F.concat_ws("", *[F.col(f"`{c}`") for c in raw.columns]) != "").coalesce(1).withColumn("_seq", F.monotonically_increasing_id())
    lob = clean_text(value("default_line_of_business"))
    rows = ordered.select(
        F.row_number().over(Window.orderBy("_seq")).alias("position"), clean_text(value("payer_id")).alias("payer_id"), clean_text(value("payer_name")).alias("payer_name"), clean_text(value("payer_alias")).alias("payer_alias"),
        normalise_host(value("hint_host")).alias("hint_host"), normalise_multi_enum(value("default_state_or_region"), vocab.STATE_OR_REGION).alias("default_state_or_region"),
        F.when(lob == "", F.lit("Unknown")).otherwise(lob).alias("default_line_of_business"), split_list(value("seed_paths")).alias("seed_paths"),
        F.transform(split_list(value("extra_hosts")), normalise_host).alias("extra_hosts"), clean_text(value("notes")).alias("notes"),
    )
    errors = F.filter(
        F.array(
            F.when(F.col("payer_name") == "", F.lit("payer_name is empty")),
            F.when(~F.contains(F.col("hint_host"), F.lit(".")), F.concat(F.lit("hint_host '"), F.col("hint_host"), F.lit("' is not a host name"))),
            F.when(~F.col("default_line_of_business").isin(*vocab.LINE_OF_BUSINESS), F.concat(F.lit("line of business '"), F.col("default_line_of_business"), F.lit("' is not known"))),
        ),
        lambda e: e.isNotNull(),
    )
    return rows.withColumn("errors", errors)


def checked(payers: DataFrame) -> DataFrame:
    """payers without errors; raises with all errors of all rows if there are any."""
    bad = payers.where(F.size("errors") > 0).select("position", "errors").collect()
    if bad:
        raise ValueError("; ".join(f"row {r['position']}: {e}" for r in bad for e in r["errors"]))
    return payers.drop("errors")


def parse_range(spec: str | None, total: int) -> list[int]:
    """Positions (from 1, sorted, each once) of a range such as 1-3,8; all, * and empty mean every one."""
    text = (spec or "").strip().lower()
    if text in ("", "all", "*"):
        return list(range(1, total + 1))
    chosen: set[int] = set()
    for chunk in filter(None, map(str.strip, text.split(","))):
        m = re.fullmatch(r"(\d+)(?:\s*-\s*(\d+))?", chunk)
        if not m:
            raise ValueError(f"{chunk!r} is neither a number nor a range such as 1-5")
        first, last = int(m[1]), int(m[2] or m[1])
        if first > last:
            raise ValueError(f"{chunk!r} starts after its end")
        if first < 1 or last > total:
            raise ValueError(f"{chunk!r} is outside 1-{total}")
        chosen.update(range(first, last + 1))
    if not chosen:
        raise ValueError(f"{spec!r} selects nothing")
    return sorted(chosen)


def select_payers(payers: DataFrame, spec: str | None) -> DataFrame:
    return payers.where(F.col("position").isin(parse_range(spec, payers.count())))


def listing() -> Column:
    """A line of the payer listing."""
    return F.format_string("%3d  %-34s %-30s %s", "position", "payer_name", "hint_host", "default_line_of_business")
