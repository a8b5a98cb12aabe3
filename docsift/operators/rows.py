"""Catalogue rows: building, normalising, validating."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.functions import vocab
from docsift.functions.classify import classify_document_type, extract_policy_number, infer_line_of_business, infer_state_or_region
from docsift.functions.dates import extract_dates, normalise_iso_date
from docsift.functions.sniff import decode_text
from docsift.functions.text import clean_text, format_bool_yn, format_confidence, format_int, in_enum, lit_array, normalise_multi_enum, sha256_hex, utc_now_iso
from docsift.functions.urls import title_from_url
from docsift.operators.html import html_text, html_title

_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"


def normalise_rows(df: DataFrame) -> DataFrame:
    """All 22 columns in legal form (others are kept); applying it again changes nothing."""
    c = lambda name: F.col(name) if name in df.columns else F.lit(vocab.DEFAULTS.get(name, ""))
    status = F.when(format_int(c("http_status")) == "", F.lit("0")).otherwise(format_int(c("http_status")))
    auth = format_bool_yn(c("requires_auth"))
    open_200 = (status == "200") & (auth == "N")
    stamp = clean_text(c("scrape_timestamp_utc"))
    out = {
        "state_or_region": normalise_multi_enum(c("state_or_region"), vocab.STATE_OR_REGION),
        "line_of_business": in_enum(clean_text(c("line_of_business")), vocab.LINE_OF_BUSINESS, "Unknown"),
        "document_title": F.substring(clean_text(c("document_title")), 1, 500),
        "document_type": in_enum(clean_text(c("document_type")), vocab.DOCUMENT_TYPE, "other"),
        "document_url": F.replace(clean_text(c("document_url"), collapse=False), F.lit(" "), F.lit("%20")),
        "source_page_url": clean_text(c("source_page_url"), collapse=False),
        "file_type": in_enum(F.lower(clean_text(c("file_type"))), vocab.FILE_TYPE, "other"),
        "effective_date": normalise_iso_date(c("effective_date")),
        "last_updated_date": normalise_iso_date(c("last_updated_date")),
        "http_status": status,
        "requires_auth": auth,
        "render_mode": in_enum(F.lower(clean_text(c("render_mode"))), vocab.RENDER_MODE, "static"),
        "extraction_method": normalise_multi_enum(c("extraction_method"), vocab.EXTRACTION_METHOD),
        "content_hash_sha256": F.when(open_200, F.lower(clean_text(c("content_hash_sha256")))).otherwise(F.lit("")),
        "file_size_bytes": F.when(open_200, format_int(c("file_size_bytes"))).otherwise(F.lit("")),
        "confidence_score": format_confidence(c("confidence_score")),
        "scrape_timestamp_utc": F.when(stamp.rlike(_TIMESTAMP), stamp).otherwise(utc_now_iso()),
    }
    rest = [x for x in df.columns if x not in vocab.COLUMNS]
    return df.select(*[out.get(name, clean_text(c(name))).alias(name) for name in vocab.COLUMNS], *rest)


def quoted(c: Column) -> Column:
    return F.concat(F.lit("'"), c, F.lit("'"))


def validation_problems() -> Column:
    """array of messages for the 22 columns of a normalised row, in a fixed order; empty for a conformant one."""
    c = F.col
    when = lambda bad, message: F.array(F.when(bad, message if isinstance(message, Column) else F.lit(message)))
    said = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    members = lambda name, allowed, tail: F.transform(
        F.filter(F.split(c(name), r"\|"), lambda p: (p != "") & ~F.array_contains(lit_array(allowed), p)), lambda p: said(f"{name} member ", quoted(p), tail)
    )
    integer = r"^\d+$"
    must = c("http_status").rlike(integer) & (F.coalesce(c("http_status").try_cast("long"), F.lit(0)) == 200) & (c("requires_auth") == "N")
    parts = [
        when(c("payer_name") == "", "payer_name is required"),
        when(c("document_url") == "", "document_url is required"),
        when((c("document_url") != "") & ~c("document_url").rlike("^https?://"), said("document_url must be absolute http(s): ", quoted(c("document_url")))),
        when(c("discovery_path") == "", "discovery_path is required (reviewer must be able to reproduce the find)"),
        *[when(~c(name).isin(*allowed), said(f"{name} ", quoted(c(name)), " outside enum")) for name, allowed in (("line_of_business", vocab.LINE_OF_BUSINESS), ("document_type", vocab.DOCUMENT_TYPE), ("file_type", vocab.FILE_TYPE), ("render_mode", vocab.RENDER_MODE))],
        members("extraction_method", vocab.EXTRACTION_METHOD, " outside enum"),
        when(c("extraction_method") == "", "extraction_method is required"),
        members("state_or_region", vocab.STATE_OR_REGION, " is not a USPS code or 'National'"),
        *[when((c(n) != "") & ~c(n).rlike(r"^\d{4}-\d{2}-\d{2}$"), said(f"{n} ", quoted(c(n)), " is not ISO-8601 YYYY-MM-DD")) for n in ("effective_date", "last_updated_date")],
        when(~c("requires_auth").isin("Y", "N"), said("requires_auth ", quoted(c("requires_auth")), " must be exactly 'Y' or 'N'")),
        when(~c("http_status").rlike(integer), said("http_status ", quoted(c("http_status")), " must be a plain integer")),
        when(must & (c("content_hash_sha256") == ""), "content_hash_sha256 is required for a 200 response"),
        when(must & (c("content_hash_sha256") != "") & ~c("content_hash_sha256").rlike("^[0-9a-f]{64}$"), "content_hash_sha256 must be lowercase hex sha-256"),
        when(c("http_status").rlike(integer) & ~must & (c("content_hash_sha256") != ""), "content_hash_sha256 must be empty when http_status != 200 or requires_auth=Y"),
        when((c("file_size_bytes") != "") & ~c("file_size_bytes").rlike(integer), said("file_size_bytes ", quoted(c("file_size_bytes")), " must be a plain integer")),
        when(~c("confidence_score").rlike(r"^(0\.\d{2}|1\.00)$"), said("confidence_score ", quoted(c("confidence_score")), " must be 0.00-1.00 with two decimals")),
        when(c("confidence_score").rlike(r"^(0\.\d{2}|1\.00)$") & (c("confidence_score").try_cast("double") < 0.70) & (c("notes") == ""), said("confidence_score ", c("confidence_score"), " < 0.70 requires an explanation in notes")),
        when(~c("scrape_timestamp_utc").rlike(_TIMESTAMP), "scrape_timestamp_utc must be UTC ISO-8601 to the second with a Z suffix"),
        *[when(F.lower(c(n)).isin(*vocab.PLACEHOLDERS), said(f"{n} uses forbidden placeholder ", quoted(c(n)), "; use an empty string")) for n in vocab.COLUMNS],
    ]
    return F.filter(F.concat(*parts), lambda m: m.isNotNull())


def validate_rows(df: DataFrame, strict: bool = False) -> DataFrame:
    """df with problems; strict raises on the first row that has any."""
    out = df.withColumn("problems", validation_problems())
    if strict:
        out = out.withColumn("problems", F.when(F.size("problems") > 0, F.raise_error(F.concat_ws("; ", F.col("document_url"), F.col("problems"))).cast("array<string>")).otherwise(F.col("problems")))
    return out


def prepare_rows(df: DataFrame, strict: bool = False) -> DataFrame:
    return validate_rows(normalise_rows(df), strict)


def confidence(success: Column, gated: Column, strength: Column, title: Column, text: Column, number: Column, dated: Column, lob: Column, enumerated: Column, truncated: Column) -> Column:
    """Score of a row from what could be read; the order of additions is part of the contract."""
    add = lambda cond, x, y=0.0: F.when(cond, F.lit(x)).otherwise(F.lit(y))
    has_title, has_text = title != "", text != ""
    score = F.lit(0.45) + F.lit(0.20) * strength
    score = score + F.when(has_title & has_text, F.lit(0.12)).when(has_title, F.lit(0.06)).otherwise(F.lit(0.0))
    score = score + add(has_text, 0.08) + add(number != "", 0.07) + add(dated, 0.08) + add(lob != "Unknown", 0.03)
    score = score - add(enumerated, 0.10) - add(truncated, 0.10)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(success, score).when(gated, F.lit(0.40)).otherwise(F.lit(0.25))))


def build_rows(fetched: DataFrame) -> DataFrame:
    """Rows from candidates joined with their payer and response.

    Columns read: payer_name, payer_alias, default_state_or_region,
    default_line_of_business, url, source_page_url, discovery_path, origin, link_text,
    status, content, final_url, truncated, file_type, requires_auth (boolean), note,
    fetched_at.  One projection after another, without a shuffle.
    """
    c, empty = F.col, F.lit("")
    step = fetched.withColumns({"_ok": (c("status") == 200) & (F.coalesce(F.length("content"), F.lit(0)) > 0) & ~c("requires_auth"), "_page": decode_text(c("content"))})
    step = step.withColumn("_html", c("_ok") & (c("file_type") == "html"))
    step = step.withColumns({"_found": html_title(c("_page")), "_text": F.when(c("_html"), html_text(c("_page"))).otherwise(empty)})
    anchor = clean_text(c("link_text"))
    step = step.withColumns({"_own": F.when(c("_html"), c("_found.title")).otherwise(empty), "_anchor": F.when(F.length(anchor).between(4, 300), anchor).otherwise(empty), "_named": title_from_url(c("url"))})
    step = step.withColumn("_title", F.when(c("_own") != "", c("_own")).when(c("_anchor") != "", c("_anchor")).otherwise(c("_named")))
    step = step.withColumns({"_number": extract_policy_number(c("_text"), c("_title"), c("url")), "_dates": extract_dates(c("_text")), "_type": classify_document_type(c("url"), c("_title"), c("_text")), "_lob": infer_line_of_business(c("url"), c("_title"), c("_text"), c("default_line_of_business"))})
    dated = (c("_dates.effective") != "") | (c("_dates.updated") != "")
    score = confidence(c("_ok"), c("requires_auth"), c("_type.strength"), c("_title"), c("_text"), c("_number"), dated, c("_lob"), c("origin") == "url_pattern", c("truncated"))
    step = step.withColumn("_score", score)
    origin = F.coalesce(*[F.when(c("origin") == o, F.lit(m)) for o, m in vocab.ORIGIN_METHODS], F.lit("css_selector"))
    methods = F.array(
        origin,
        F.when(c("_html") & (c("_own") != ""), F.lit("regex")),
        F.when((c("_own") == "") & (c("_anchor") != ""), F.lit("css_selector")),
        F.when((c("_own") == "") & (c("_anchor") == "") & (c("_named") != ""), F.lit("url_pattern")),
        F.when((c("_number") != "") | dated, F.lit("regex")),
    )
    reasons = [
        F.when(c("_ok") & (c("file_type") == "pdf"), F.lit("PDF text extraction returned nothing (likely a scanned image or an unsupported encoding); metadata inferred from the URL")),
        F.when(c("_ok") & ~c("file_type").isin("pdf", "html"), F.concat(c("file_type"), F.lit(" content is identified and hashed but not parsed; title and dates inferred from the URL and link text"))),
        F.when((c("_own") == "") & (c("_anchor") == "") & (c("_named") != ""), F.lit("title derived from the URL filename, not from the document")),
        F.when(c("_ok") & (c("origin") == "url_pattern"), F.lit("found by bounded URL-pattern enumeration rather than a link")),
        F.when(c("_ok") & c("truncated"), F.lit("document exceeded the download cap and was truncated; content_hash_sha256 covers only the retrieved prefix")),
        F.when(~c("_ok") & c("requires_auth"), F.lit("document is behind authentication; metadata limited to what the public URL and link text reveal")),
        F.when(~c("_ok") & ~c("requires_auth"), F.concat(F.lit("document could not be retrieved (http_status "), c("status").cast("string"), F.lit("); row kept as evidence of the attempt"))),
    ]
    explain = (c("_score") < 0.70) | c("truncated")
    moved = F.when((F.coalesce(c("final_url"), empty) != "") & (c("final_url") != c("url")), F.concat(F.lit("redirected to "), c("final_url")))
    notes = F.transform(F.array(c("note"), *[F.when(explain, r) for r in reasons], moved), lambda p: F.regexp_replace(clean_text(p), "^[; ]+|[; ]+$", ""))
    notes = F.array_join(F.array_distinct(F.filter(notes, lambda p: p != "")), "; ")
    made = {
        "state_or_region": infer_state_or_region(c("url"), c("_title"), c("default_state_or_region")),
        "line_of_business": c("_lob"), "document_title": c("_title"), "document_type": c("_type.document_type"), "document_url": c("url"),
        "file_type": F.when(F.coalesce(c("file_type"), empty) != "", c("file_type")).when(c("_ok"), F.lit("html")).otherwise(F.lit("other")),
        "policy_number": c("_number"), "effective_date": c("_dates.effective"), "last_updated_date": c("_dates.updated"), "http_status": c("status"),
        "content_hash_sha256": F.when(c("_ok"), sha256_hex(c("content"))).otherwise(empty),
        "file_size_bytes": F.when(F.coalesce(F.length("content"), F.lit(0)) > 0, F.length("content").cast("string")).otherwise(empty),
        "requires_auth": F.when(c("requires_auth"), F.lit("Y")).otherwise(F.lit("N")), "render_mode": F.lit("static"),
        "extraction_method": F.array_join(F.array_distinct(F.filter(methods, lambda m: m.isNotNull())), "|"),
        "confidence_score": c("_score"), "scrape_timestamp_utc": c("fetched_at"), "notes": F.substring(notes, 1, 1000),
    }
    return normalise_rows(step.select(*[made.get(name, F.col(name) if name in fetched.columns else empty).alias(name) for name in vocab.COLUMNS]))
