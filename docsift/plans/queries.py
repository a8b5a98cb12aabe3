"""Registered queries over the generic tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.functions import classify, dates, sniff, text, urls, vocab
from docsift.operators import dedupe, enumeration, html, pacing, report, robots, rows, sitemap
from docsift.plans import duck as d
from docsift.plans import views
from docsift.plans.registry import query

Q = d.q
_roots: dict[str, str] = {}


def store(df: DataFrame) -> DataFrame:
    """Cut lineage in the shared checkpoint folder (our own only where none is set)."""
    context = df.sparkSession.sparkContext
    named = df.sparkSession.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(named or _roots.setdefault(context.applicationId, tempfile.mkdtemp(prefix="docsift-checkpoint-")))
    return df.checkpoint()


def _documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _pages(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


# --- scalar normalisers -------------------------------------------------------------------------------------------

_MESSY = (
    "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN ' ' || text || '​  x　' WHEN 1 THEN text || ' N/A ' WHEN 2 THEN '﻿' || text ELSE text END AS v, "
    "CASE doc_id % 6 WHEN 0 THEN 'n/a' WHEN 1 THEN ' N/A ' WHEN 2 THEN NULL WHEN 3 THEN 'Not Applicable' WHEN 4 THEN source || '   ﻿' || lang ELSE '--' END AS w FROM {documents}"
)


@query("p1_clean_text", f"SELECT doc_id, {d.clean('v')} AS cleaned, {d.clean('w')} AS odd FROM ({views.for_duck(_MESSY)})")
def p1(spark, sf_dir):
    return spark.sql(_MESSY, **views.read(spark, sf_dir, "documents")).select("doc_id", text.clean_text(F.col("v")).alias("cleaned"), text.clean_text(F.col("w")).alias("odd"))


_MONTHS = "CASE m " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate("January February March April May June July August September October November December".split(), 1)) + " END"
_DATED = f"""
SELECT o_orderkey, y, m, dd, CASE o_orderkey % 12
  WHEN 0 THEN ys || '-' || lpad(ms, 2, '0') || '-' || lpad(ds, 2, '0') WHEN 1 THEN ms || '/' || ds || '/' || ys WHEN 2 THEN lpad(ms, 2, '0') || '-' || lpad(ds, 2, '0') || '-' || ys
  WHEN 3 THEN mn || ' ' || ds || ', ' || ys WHEN 4 THEN ds || ' ' || mn || ' ' || ys WHEN 5 THEN 'Effective date: ' || ms || '/' || ds || '/' || ys || '.'
  WHEN 6 THEN ys || lpad(ms, 2, '0') || lpad(ds, 2, '0') WHEN 7 THEN substr(mn, 1, 3) || ' ' || ys WHEN 8 THEN 'no date' WHEN 9 THEN ys || '-13-45' WHEN 10 THEN ds || '-' || substr(mn, 1, 3) || '-' || ys
  ELSE ms || '/' || ds || '/' || substr(ys, 3, 2) END AS v
FROM (SELECT o_orderkey, y, m, dd, CAST(y AS STRING) AS ys, CAST(m AS STRING) AS ms, CAST(dd AS STRING) AS ds, {_MONTHS} AS mn
  FROM (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS dd FROM {{orders}}))
"""
_ISO = "CAST(y AS VARCHAR) || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-' ||"


@query("p2_iso_date", f"SELECT o_orderkey, CASE WHEN o_orderkey % 12 IN (8, 9) THEN '' WHEN o_orderkey % 12 = 7 THEN {_ISO} '01' ELSE {_ISO} lpad(CAST(dd AS VARCHAR), 2, '0') END AS iso FROM ({_DATED.replace('{orders}', 'orders')})")
def p2(spark, sf_dir):
    return spark.sql(_DATED, **views.read(spark, sf_dir, "orders")).select("o_orderkey", dates.normalise_iso_date(F.col("v")).alias("iso"))


@query("p3_multi_enum", f"SELECT seq, {d.multi_enum('state_or_region', vocab.STATE_OR_REGION)} AS states, {d.multi_enum('extraction_method', vocab.EXTRACTION_METHOD)} AS methods FROM ({views.DUCK_ROWS})")
def p3(spark, sf_dir):
    out = views.rows(spark, sf_dir)
    return out.select("seq", text.normalise_multi_enum(F.col("state_or_region"), vocab.STATE_OR_REGION).alias("states"), text.normalise_multi_enum(F.col("extraction_method"), vocab.EXTRACTION_METHOD).alias("methods"))


_NUMBERS = "SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN '0.456' WHEN 1 THEN '1.7' WHEN 2 THEN '-2' WHEN 3 THEN 'abc' WHEN 4 THEN NULL WHEN 5 THEN '1,234' WHEN 6 THEN ' 00' || CAST(o_custkey AS STRING) ELSE CASE o_orderkey % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'TRUE' ELSE 'n' END END AS v FROM {orders}"
_NUMBERS_DUCK = _NUMBERS.replace("{orders}", "orders")


@query("p4_confidence", f"SELECT o_orderkey, {d.conf('v')} AS confidence FROM ({_NUMBERS_DUCK})")
def p4(spark, sf_dir):
    return spark.sql(_NUMBERS, **views.read(spark, sf_dir, "orders")).select("o_orderkey", text.format_confidence(F.col("v")).alias("confidence"))


@query("p5_int", f"SELECT o_orderkey, {d.whole('v')} AS whole FROM ({_NUMBERS_DUCK})")
def p5(spark, sf_dir):
    return spark.sql(_NUMBERS, **views.read(spark, sf_dir, "orders")).select("o_orderkey", text.format_int(F.col("v")).alias("whole"))


@query("p6_bool", f"SELECT o_orderkey, {d.yn('v')} AS yn FROM ({_NUMBERS_DUCK})")
def p6(spark, sf_dir):
    return spark.sql(_NUMBERS, **views.read(spark, sf_dir, "orders")).select("o_orderkey", text.format_bool_yn(F.col("v")).alias("yn"))


@query("p7_sha256", "SELECT doc_id, sha256(text) AS digest FROM documents")
def p7(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", text.sha256_hex(F.encode("text", "UTF-8")).alias("digest"))


def _normalised_duck() -> str:
    """normalise_rows over ROWS; dates by the two shapes that ROWS has."""
    months = "CASE regexp_extract(x, '^([A-Za-z]+) ', 1) WHEN 'March' THEN 3 END"
    iso = lambda c: (
        f"(SELECT CASE WHEN regexp_matches(x, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN x WHEN regexp_matches(x, '^[0-9]+/[0-9]+/[0-9]{{4}}$') THEN printf('%s-%02d-%02d', string_split(x, '/')[3], CAST(string_split(x, '/')[1] AS INT), CAST(string_split(x, '/')[2] AS INT)) "
        f"WHEN regexp_matches(x, '^[A-Za-z]+ [0-9]+, [0-9]{{4}}$') THEN printf('%s-%02d-%02d', regexp_extract(x, ', ([0-9]{{4}})$', 1), {months}, CAST(regexp_extract(x, ' ([0-9]+),', 1) AS INT)) ELSE '' END FROM (SELECT {d.clean(c)} AS x))"
    )
    open_200 = f"({d.whole('http_status')} = '200' AND {d.yn('requires_auth')} = 'N')"
    made = {
        "state_or_region": d.multi_enum("state_or_region", vocab.STATE_OR_REGION), "line_of_business": d.in_enum(d.clean("line_of_business"), vocab.LINE_OF_BUSINESS, "Unknown"),
        "document_title": f"substr({d.clean('document_title')}, 1, 500)", "document_type": d.in_enum(d.clean("document_type"), vocab.DOCUMENT_TYPE, "other"),
        "document_url": f"replace({d.clean('document_url', False)}, ' ', '%20')", "source_page_url": d.clean("source_page_url", False),
        "file_type": d.in_enum(f"lower({d.clean('file_type')})", vocab.FILE_TYPE, "other"), "effective_date": iso("effective_date"), "last_updated_date": iso("last_updated_date"),
        "http_status": f"(CASE WHEN {d.whole('http_status')} = '' THEN '0' ELSE {d.whole('http_status')} END)", "content_hash_sha256": f"(CASE WHEN {open_200} THEN lower(content_hash_sha256) ELSE '' END)",
        "file_size_bytes": f"(CASE WHEN {open_200} THEN {d.whole('file_size_bytes')} ELSE '' END)", "requires_auth": d.yn("requires_auth"), "render_mode": d.in_enum(f"lower({d.clean('render_mode')})", vocab.RENDER_MODE, "static"),
        "extraction_method": d.multi_enum("extraction_method", vocab.EXTRACTION_METHOD), "confidence_score": d.conf("confidence_score"), "scrape_timestamp_utc": d.clean("scrape_timestamp_utc"),
    }
    return "SELECT " + ", ".join(f"{made.get(c, d.clean(c))} AS {c}" for c in vocab.COLUMNS) + f", seq FROM ({views.DUCK_ROWS})"


NORMALISED = _normalised_duck()


@query("p9_normalise", NORMALISED)
def p9(spark, sf_dir):
    return rows.normalise_rows(views.rows(spark, sf_dir))


def _problems_duck() -> str:
    """validate_rows over the normalised rows, for the rules that those can break."""
    c = [
        "CASE WHEN discovery_path = '' THEN 'discovery_path is required (reviewer must be able to reproduce the find)' END",
        "CASE WHEN extraction_method = '' THEN 'extraction_method is required' END",
        "CASE WHEN http_status = '200' AND requires_auth = 'N' AND content_hash_sha256 = '' THEN 'content_hash_sha256 is required for a 200 response' END",
        "CASE WHEN CAST(confidence_score AS DOUBLE) < 0.70 AND notes = '' THEN 'confidence_score ' || confidence_score || ' < 0.70 requires an explanation in notes' END",
    ]
    return f"SELECT seq, array_to_string(list_filter([{', '.join(c)}], lambda x: x IS NOT NULL), ' | ') AS problems FROM ({NORMALISED})"


@query("f17_validate", _problems_duck())
def f17(spark, sf_dir):
    return rows.prepare_rows(views.rows(spark, sf_dir)).select("seq", F.array_join("problems", " | ").alias("problems"))


# --- URLs -------------------------------------------------------------------------------------------------------------

_URLS = (
    "SELECT page_id, CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN replace(url, 'http://', 'HTTP://') || '/index.html' WHEN 2 THEN replace(url, 'example', 'user@Example') || '?b=2&a=1&utm_x=3' "
    "WHEN 3 THEN replace(url, '.com/', '.com:80//x//') ELSE replace(url, '.org/', '.org:443/a/../') || '/' END AS url FROM {pages}"
)
_URLS_DUCK = _URLS.replace("{pages}", "pages")


def _urls(spark, sf_dir):
    return spark.sql(_URLS, **views.read(spark, sf_dir, "pages"))


@query("u1_canonical_url", f"SELECT page_id, {d.canonical('url')} AS url_key FROM ({_URLS_DUCK})")
def u1(spark, sf_dir):
    return _urls(spark, sf_dir).select("page_id", urls.normalise_url(F.col("url")).alias("url_key"))


_HOSTS = "SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN source || '.example.co.uk' WHEN 1 THEN 'WWW.' || source || '.com' WHEN 2 THEN 'localhost' WHEN 3 THEN '.a.b.' || lang || '.org.' WHEN 4 THEN '' ELSE 'docs.' || lang || '.net.au' END AS h FROM {documents}"


@query("u2_registrable_domain", f"SELECT doc_id, {d.domain('h')} AS domain FROM ({views.for_duck(_HOSTS)})")
def u2(spark, sf_dir):
    return spark.sql(_HOSTS, **views.read(spark, sf_dir, "documents")).select("doc_id", urls.registrable_domain(F.col("h")).alias("domain"))


@query("u3_scope", f"SELECT page_id, h, (h <> '' AND ({d.domain('h')} = 'example.com' OR h IN ('thther.example.org', 'cdn.test') OR ends_with(h, '.thther.example.org') OR {d.domain('h')} IN ('example.org', 'cdn.test'))) AS in_scope FROM (SELECT page_id, {d.host('url')} AS h FROM pages)")
def u3(spark, sf_dir):
    h = urls.host(F.col("url"))
    return _pages(spark, sf_dir).select("page_id", h.alias("h"), urls.in_scope(h, F.lit("www.example.com"), text.lit_array(["thther.example.org", " CDN.test "])).alias("in_scope"))


_HREFS = ("../a/b.pdf", "/root/x?y=1#z", "?page=2", "//other.org/p", "mailto:a@b", "sub/./c/../d.html", "#top", "https://abs.example.net/q", "JavaScript:void(0)", "../../../up", "")
_HREF_CASE = "CASE page_id % 11 " + " ".join(f"WHEN {k} THEN '{h}'" for k, h in enumerate(_HREFS)) + " END"
_EXPECTED = ("https://h.org/a/a/b.pdf", "https://h.org/root/x?y=1", "https://h.org/a/b/c.html?page=2", "https://other.org/p", None, "https://h.org/a/b/sub/d.html", None, "https://abs.example.net/q", None, "https://h.org/up", None)


@query("u4_resolve_links", "SELECT page_id, CASE page_id % 11 " + " ".join(f"WHEN {k} THEN '{e}'" for k, e in enumerate(_EXPECTED) if e) + " END AS link FROM pages")
def u4(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", urls.resolve(F.lit("https://h.org/a/b/c.html"), F.expr(_HREF_CASE)).alias("link"))


_TITLES_DUCK = views.for_duck(views.TITLES)
_LOW_PATH = f"lower({d.part('url', 3)})"


def _stem_duck() -> str:
    stem = f"regexp_replace(list_last(string_split({d.part('url', 3)}, '/')), '(?i)(\\.pdf|\\.docx?|\\.xlsx?|\\.rtf)$', '')"
    stem = d.clean(f"regexp_replace(regexp_replace({stem}, '[_\\-+.]+', ' ', 'g'), '%[0-9A-Fa-f]{{2}}', ' ', 'g')")
    word = "CASE WHEN (w = upper(w) AND w <> lower(w)) OR regexp_matches(w, '[0-9]') THEN w ELSE upper(w[1]) || lower(w[2:]) END"
    return f"SELECT id, CASE WHEN length(s) < 3 THEN '' ELSE substr(array_to_string(list_transform(string_split(s, ' '), lambda w: {word}), ' '), 1, 200) END AS title FROM (SELECT id, {stem} AS s FROM ({_TITLES_DUCK}))"


@query("u5_title_from_url", _stem_duck())
def u5(spark, sf_dir):
    return views.titles(spark, sf_dir).select("id", urls.title_from_url(F.col("url")).alias("title"))


_NAMES = "SELECT id, CASE id % 6 WHEN 0 THEN title || ': draft/\"v1\"' WHEN 1 THEN 'con.txt' WHEN 2 THEN '  a%20b+c  d.pdf. ' WHEN 3 THEN '???' WHEN 4 THEN 'bad%zz name' ELSE title || ' ' || body || title || title END AS v FROM "
_SAFE = (
    "SELECT id, CASE WHEN t = '' THEN 'document' ELSE substr(CASE WHEN lower(string_split(t, '.')[1]) IN (" + d.listed(vocab.RESERVED_NAMES) + ") THEN 'file_' || t ELSE t END, 1, 90) END AS name FROM ("
    "SELECT id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(CASE WHEN id % 6 = 4 THEN v ELSE url_decode(v) END), '[<>:\"/\\\\|?*\\x00-\\x1f]+', '_', 'g'), '\\s+', '_', 'g'), '_{2,}', '_', 'g'), '^[._ ]+|[._ ]+$', '', 'g') AS t FROM ("
    + _NAMES + f"({_TITLES_DUCK})))"
)


@query("u6_safe_filename", _SAFE)
def u6(spark, sf_dir):
    named = spark.sql(_NAMES + "{t}", t=views.titles(spark, sf_dir))
    return named.select("id", urls.sanitize_filename(F.col("v")).alias("name"))


def _archive_duck() -> str:
    last = f"url_decode(list_last(string_split({d.part('url', 3)}, '/')))"
    stem = f"regexp_replace({last}, '(?i)(\\.pdf|\\.html?|\\.docx?|\\.xlsx?|\\.aspx)$', '')"
    near = f"array_to_string(list_slice(list_filter(string_split({d.part('url', 3)}, '/'), lambda x: x <> ''), -3, -1), '_')"
    stem = f"CASE WHEN length({stem}) < 3 OR regexp_matches({stem}, '^[0-9]+$') THEN CASE WHEN {near} = '' THEN 'document' ELSE {near} END ELSE {stem} END"
    safe = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(s), '[<>:\"/\\\\|?*\\x00-\\x1f]+', '_', 'g'), '\\s+', '_', 'g'), '_{2,}', '_', 'g'), '^[._ ]+|[._ ]+$', '', 'g')"
    return f"SELECT id, 'Payer_One/' || {safe} || '_' || substr(sha256(url), 1, 10) || '.pdf' AS path FROM (SELECT id, url, {stem} AS s FROM ({_TITLES_DUCK}))"


@query("u7_archive_path", _archive_duck())
def u7(spark, sf_dir):
    return views.titles(spark, sf_dir).select("id", urls.archive_path(F.lit("Payer One"), F.col("url"), F.lit(""), F.lit("pdf")).alias("path"))


def _ends(c: str, endings) -> str:
    return f"regexp_matches({c}, {Q('(' + '|'.join(d.quote(e) for e in endings) + ')$')})"


_LOW = "lower(url)"
_IS_DOC = f"(NOT {_ends(_LOW_PATH, vocab.NEGATIVE_EXTENSIONS)} AND ({_ends(_LOW_PATH, vocab.DOCUMENT_EXTENSIONS)} OR {d.any_word(f'lower({d.part("url", 4)})', vocab.DOCUMENT_QUERY_HINTS)} OR ({d.any_word(_LOW_PATH, vocab.ASSET_ROUTES)} AND {d.any_word(_LOW, vocab.ASSET_STEMS)})))"


@query("f1_document_url", f"SELECT id, {_IS_DOC} AS is_document FROM ({_TITLES_DUCK})")
def f1(spark, sf_dir):
    return views.titles(spark, sf_dir).select("id", urls.looks_like_document_url(F.col("url")).alias("is_document"))


@query("f2_index_text", f"SELECT id, (length(lower({d.clean('title')})) BETWEEN 1 AND 120 AND {d.any_word(f'lower({d.clean("title")})', vocab.INDEX_TEXT_HINTS)}) AS is_index FROM ({_TITLES_DUCK})")
def f2(spark, sf_dir):
    return views.titles(spark, sf_dir).select("id", urls.looks_like_policy_index(F.col("title")).alias("is_index"))


@query("f4_noise", f"SELECT id, {d.any_word(_LOW, vocab.POLICY_PATH_HINTS)} AS hinted, CASE WHEN {d.any_word(_LOW, vocab.NOISE_PATH_HINTS)} THEN NOT {d.any_word(_LOW, vocab.POLICY_PATH_HINTS)} ELSE {_ends(_LOW, vocab.NEGATIVE_EXTENSIONS)} END AS noise FROM ({_TITLES_DUCK})")
def f4(spark, sf_dir):
    return views.titles(spark, sf_dir).select("id", urls.has_policy_hint(F.col("url")).alias("hinted"), urls.is_noise(F.col("url")).alias("noise"))


@query("p12_labels", f"SELECT id, CASE WHEN {_LOW_PATH} LIKE '%.pdf' THEN 'anchor[href$=''.pdf'']' WHEN {_LOW_PATH} LIKE '%.docx' THEN 'anchor[href$=''.docx'']' WHEN {_LOW_PATH} LIKE '%.xlsx' THEN 'anchor[href$=''.xlsx'']' ELSE 'anchor[href]' END AS selector, {d.part('url', 3)} AS label, CASE WHEN length({d.clean('title')}) <= 12 THEN {d.clean('title')} ELSE substr({d.clean('title')}, 1, 9) || '...' END AS short FROM ({_TITLES_DUCK})")
def p12(spark, sf_dir):
    return views.titles(spark, sf_dir).select("id", urls.anchor_selector(F.col("url")).alias("selector"), urls.page_label(F.col("url")).alias("label"), text.trim_label(F.col("title"), 12).alias("short"))


# --- responses --------------------------------------------------------------------------------------------------------

_STATUSES = "CASE doc_id % 9 WHEN 0 THEN 401 WHEN 1 THEN 406 WHEN 2 THEN 429 WHEN 3 THEN 0 ELSE 200 END"
_HEADS = ("%PDF-1.7 ", "", "<!DOCTYPE html><html>Please LOG in: Please log in", "<html>Checking your browser before accessing", "<?xml version=\"1.0\"?>", "{\\rtf1 ", "  <HTML>captcha Access Denied")
_HEAD_CASE = "CASE doc_id % 7 " + " ".join(f"WHEN {k} THEN {{}}" for k in range(7)) + " END"
_RAW_DUCK = f"SELECT doc_id, {_STATUSES} AS status, doc_id % 7 AS k, {_HEAD_CASE.format(*map(Q, _HEADS))} || text AS body, 'https://' || CASE WHEN doc_id % 10 = 0 THEN 'secure.x.org/SignIn' ELSE 'x.org/a' END || CASE doc_id % 4 WHEN 0 THEN '.xlsx' WHEN 1 THEN '.htm' WHEN 2 THEN '.Doc' ELSE '' END AS url, CASE doc_id % 3 WHEN 0 THEN 'Application/PDF; charset=utf-8' WHEN 1 THEN '' ELSE 'text/plain' END AS header FROM documents"


def _raw(spark, sf_dir):
    i = F.col("doc_id")
    head = F.get(F.array(*[F.lit(h) for h in _HEADS]), (i % 7).cast("int"))
    url = F.concat(F.lit("https://"), F.when(i % 10 == 0, F.lit("secure.x.org/SignIn")).otherwise(F.lit("x.org/a")), F.get(F.array(F.lit(".xlsx"), F.lit(".htm"), F.lit(".Doc"), F.lit("")), (i % 4).cast("int")))
    header = F.get(F.array(F.lit("Application/PDF; charset=utf-8"), F.lit(""), F.lit("text/plain")), (i % 3).cast("int"))
    return _documents(spark, sf_dir).select("doc_id", F.expr(_STATUSES).alias("status"), F.encode(F.concat(head, F.col("text")), "UTF-8").alias("content"), url.alias("url"), header.alias("header"))


_KIND = "(CASE k WHEN 0 THEN 'pdf' WHEN 1 THEN '' WHEN 2 THEN 'html' WHEN 3 THEN 'html' WHEN 4 THEN 'xml' WHEN 5 THEN 'doc' ELSE 'html' END)"
_EXT = "(CASE doc_id % 4 WHEN 0 THEN 'xlsx' WHEN 1 THEN 'html' WHEN 2 THEN 'doc' ELSE 'other' END)"


@query("x12_sniff", f"SELECT doc_id, {_KIND} AS kind FROM ({_RAW_DUCK})")
def x12(spark, sf_dir):
    return _raw(spark, sf_dir).select("doc_id", sniff.sniff_kind(F.col("content")).alias("kind"))


@query("x13_file_type", f"SELECT doc_id, CASE WHEN k = 0 THEN 'pdf' WHEN k IN (2, 3, 4, 6) THEN 'html' WHEN doc_id % 3 = 0 THEN 'pdf' ELSE {_EXT} END AS file_type FROM ({_RAW_DUCK})")
def x13(spark, sf_dir):
    return _raw(spark, sf_dir).select("doc_id", sniff.detect_file_type(F.col("content"), F.col("header"), F.col("url")).alias("file_type"))


@query("f6_challenge", f"SELECT doc_id, CASE WHEN status IN (401, 406) THEN 'http_' || CAST(status AS VARCHAR) WHEN {_KIND} NOT IN ('html', '') THEN '' ELSE coalesce({d.first_word('lower(body)', vocab.CHALLENGE_MARKERS)}, '') END AS evidence FROM ({_RAW_DUCK})")
def f6(spark, sf_dir):
    headers = F.create_map(F.lit("server"), F.lit("nginx"))
    return _raw(spark, sf_dir).select("doc_id", sniff.challenge(F.col("status"), headers, F.col("content")).alias("evidence"))


@query("f7_auth", f"SELECT doc_id, CASE WHEN status = 401 THEN 'http_401' WHEN {_KIND} NOT IN ('html', '') THEN '' ELSE coalesce({d.first_word('lower(body)', vocab.AUTH_MARKERS)}, CASE WHEN doc_id % 10 = 0 THEN 'redirected_to_signin' END, '') END AS evidence FROM ({_RAW_DUCK})")
def f7(spark, sf_dir):
    return _raw(spark, sf_dir).select("doc_id", sniff.auth_gate(F.col("status"), F.col("content"), F.col("url")).alias("evidence"))


@query("s9_robots_policy", f"SELECT doc_id, (status = 200 AND {_KIND} NOT IN ('html', 'xml')) AS fetched, (status NOT IN (401, 0)) AS default_allow FROM ({_RAW_DUCK})")
def s9(spark, sf_dir):
    policy = sniff.robots_policy(F.col("status"), F.col("content"))
    return _raw(spark, sf_dir).select("doc_id", policy["fetched"].alias("fetched"), policy["default_allow"].alias("default_allow"))


@query("g4_outcome", f"SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'robots' WHEN status = 0 THEN 'failed' WHEN status IN (401, 406) OR ({_KIND} IN ('html', '') AND {d.any_word('lower(body)', vocab.CHALLENGE_MARKERS)}) THEN 'challenged' WHEN {_KIND} IN ('html', '') AND ({d.any_word('lower(body)', vocab.AUTH_MARKERS)} OR doc_id % 10 = 0) THEN 'gated' WHEN status <> 200 THEN 'non_200' WHEN k = 1 AND doc_id % 3 <> 0 AND doc_id % 4 = 3 THEN 'unrecognised' ELSE 'ok' END AS outcome FROM ({_RAW_DUCK})")
def g4(spark, sf_dir):
    c, headers = F.col, F.create_map(F.lit("server"), F.lit("nginx"))
    kind = sniff.detect_file_type(c("content"), c("header"), c("url"))
    became = report.outcome(F.lit(False), c("doc_id") % 11 != 0, c("status"), sniff.challenge(c("status"), headers, c("content")), sniff.auth_gate(c("status"), c("content"), c("url")), sniff.ok(c("status"), c("content")), kind, sniff.sniff_kind(c("content")))
    return _raw(spark, sf_dir).select("doc_id", became.alias("outcome"))


@query("x16_backoff", "SELECT event_id, least(60.0, 1.5 * pow(2.0, event_id % 9)) AS delay, least(120.0, CAST(event_id % 200 AS DOUBLE)) AS retry_after, (user_id % 600) IN (408, 425, 429, 500, 502, 503, 504) AS retryable FROM events")
def x16(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", sniff.backoff_delay(F.col("event_id") % 9 + 1, 1.5).alias("delay"), sniff.retry_after_seconds((F.col("event_id") % 200).cast("string")).alias("retry_after"), sniff.is_retryable(F.col("user_id") % 600).alias("retryable"))


# --- extraction and classification ------------------------------------------------------------------------------------

_STRONG = "lower(title || ' ' || url)"
_WEAK = "lower(body)"


@query("x5_type", f"SELECT id, {d.doc_type(_STRONG, _WEAK, 'type')} AS document_type, CAST({d.doc_type(_STRONG, _WEAK, 'strength')} AS DOUBLE) AS strength FROM ({_TITLES_DUCK})")
def x5(spark, sf_dir):
    kind = classify.classify_document_type(F.col("url"), F.col("title"), F.col("body"))
    return views.titles(spark, sf_dir).select("id", kind["document_type"].alias("document_type"), kind["strength"].alias("strength"))


@query("x6_lob", f"SELECT id, CASE WHEN len({d.lob_hits(_STRONG)}) >= 2 THEN 'Multiple' WHEN len({d.lob_hits(_STRONG)}) = 1 THEN {d.lob_hits(_STRONG)}[1] WHEN len({d.lob_hits(_WEAK)}) >= 3 THEN 'Multiple' WHEN len({d.lob_hits(_WEAK)}) = 1 THEN {d.lob_hits(_WEAK)}[1] WHEN line_default = 'nonsense' THEN 'Unknown' ELSE line_default END AS line_of_business FROM ({_TITLES_DUCK})")
def x6(spark, sf_dir):
    return views.titles(spark, sf_dir).select("id", classify.infer_line_of_business(F.col("url"), F.col("title"), F.col("body"), F.col("line_default")).alias("line_of_business"))


_STATES = "list_filter([" + ", ".join([f"CASE WHEN contains({_STRONG}, {Q(n)}) THEN {Q(c)} END" for n, c in vocab.STATE_NAMES] + [f"CASE WHEN regexp_matches({_LOW}, '/{c}/|/{c}-|[/_-]{c}\\.|//{c}\\.') THEN {Q(c.upper())} END" for c in sorted(x.lower() for x in vocab.USPS_CODES)]) + "], lambda x: x IS NOT NULL)"


@query("x7_state", f"SELECT id, CASE WHEN len(f) > 0 THEN array_to_string(list_slice({d.distinct('f')}, 1, 6), '|') WHEN national THEN 'National' ELSE dflt END AS state FROM (SELECT id, {_STATES} AS f, {d.any_word(_STRONG, ('national', 'all states'))} AS national, {d.multi_enum('state_default', vocab.STATE_OR_REGION)} AS dflt FROM ({_TITLES_DUCK}))")
def x7(spark, sf_dir):
    return views.titles(spark, sf_dir).select("id", classify.infer_state_or_region(F.col("url"), F.col("title"), F.col("state_default")).alias("state"))


_ANCHORED = "lower(url || ' ' || title)"
_SCORE = "1.0 + (CASE WHEN " + _LOW_PATH + " LIKE '%.pdf' THEN 1.2 ELSE 0 END)" + "".join(f" + (CASE WHEN contains({_ANCHORED}, {Q(w)}) THEN {x} ELSE 0 END)" for w, x in vocab.SCORE_WEIGHTS) + "".join(f" - (CASE WHEN contains({_ANCHORED}, {Q(w)}) THEN {x} ELSE 0 END)" for w, x in vocab.SCORE_PENALTIES)


@query("x8_score", f"SELECT id, CAST(round(greatest(0, {_SCORE} + least(0.4, 0.05 * (length({d.part('url', 3)}) - length(replace({d.part('url', 3)}, '/', ''))))), 3) AS DOUBLE) AS score FROM ({_TITLES_DUCK})")
def x8(spark, sf_dir):
    return views.titles(spark, sf_dir).select("id", classify.score_candidate(F.col("url"), F.col("title")).alias("score"))


def _number_duck() -> str:
    tries = []
    for c in ("substr(body, 1, 8000)", "title", "url"):
        for p in vocab.POLICY_NUMBER_PATTERNS:
            v = f"regexp_replace({d.clean(f'regexp_extract({c}, {Q(p)}, 1)')}, '^[.,;:\\-_/]+|[.,;:\\-_/]+$', '', 'g')"
            tries.append(f"CASE WHEN length({v}) BETWEEN 3 AND 32 AND NOT regexp_matches({v}, '^(19|20)[0-9]{{2}}$') THEN upper({v}) END")
    return f"coalesce({', '.join(tries)}, '')"


@query("x3_policy_no", f"SELECT id, {_number_duck()} AS policy_number FROM ({_TITLES_DUCK})")
def x3(spark, sf_dir):
    return views.titles(spark, sf_dir).select("id", classify.extract_policy_number(F.col("body"), F.col("title"), F.col("url")).alias("policy_number"))


@query("x4_dates", f"SELECT id, CASE WHEN body LIKE '%Effective date: 03/01/2026%' THEN '2026-03-01' WHEN body LIKE '%effective 5 March 2026%' THEN '2026-03-05' ELSE '' END AS effective, CASE WHEN body LIKE '%Last reviewed January 5, 2026%' THEN '2026-01-05' WHEN body LIKE '%revised 2/3/24%' THEN '2024-02-03' ELSE '' END AS updated FROM ({_TITLES_DUCK})")
def x4(spark, sf_dir):
    found = dates.extract_dates(F.col("body"))
    return views.titles(spark, sf_dir).select("id", found["effective"].alias("effective"), found["updated"].alias("updated"))


@query("f10_verify", f"SELECT id, (NOT {d.any_word('lower(title)', vocab.SOFT_404_MARKERS)} AND (id % 4 = 0 OR (length(lower({d.clean('title')})) >= 8 AND {d.doc_type(_STRONG, _WEAK, 'type')} <> 'other'))) AS verified FROM ({_TITLES_DUCK})")
def f10(spark, sf_dir):
    kind = classify.classify_document_type(F.col("url"), F.col("title"), F.col("body"))["document_type"]
    binary = F.when(F.col("id") % 4 == 0, F.lit("pdf")).otherwise(F.lit("html"))
    return views.titles(spark, sf_dir).select("id", classify.verify_enumerated(F.col("title"), binary, F.lit(""), kind).alias("verified"))


def _unescaped(c):
    for name, char in vocab.REFERENCES:
        c = f"replace({c}, {Q(name)}, {Q(char)})"
    return c


def _inner(tag):
    inner = f"regexp_extract(html, {Q(rf'(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>')}, 1)"
    return d.clean(_unescaped(f"regexp_replace({inner}, '<[^>]+>', ' ', 'g')"))


_NO_H1 = "replace(html, 'h1>', 'h2>')"
_TITLED = f"""CASE page_id % 5 WHEN 0 THEN html WHEN 1 THEN concat('<meta property="og:title" content="Og ', page_id, ' &amp; more">', {_NO_H1})
    WHEN 2 THEN concat({_NO_H1}, '<META content="Dc > ', page_id, '" name="dc.title">') WHEN 3 THEN concat('<!-- <h1>In a comment</h1> -->', {_NO_H1}) ELSE concat('<h1>ab</h1><meta name="title" content="abc">', {_NO_H1}) END"""


@query("x1_html_title", f"SELECT page_id, CASE page_id % 5 WHEN 1 THEN 'Og ' || page_id || ' & more' WHEN 2 THEN 'Dc > ' || page_id WHEN 0 THEN CASE WHEN length(h) BETWEEN 4 AND 300 THEN h ELSE t END ELSE t END AS title FROM (SELECT page_id, {_inner('h1')} AS h, {d.clean(f'regexp_replace({_inner("title")}, {Q(vocab.TITLE_BOILERPLATE)}, {Q("")})')} AS t FROM pages)")
def x1(spark, sf_dir):
    return _pages(spark, sf_dir).withColumn("html", F.expr(_TITLED)).select("page_id", html.html_title(F.col("html"))["title"].alias("title"))


_DROP = "html"
for _tag in ("script", "style", "noscript", "nav", "footer", "header"):
    _DROP = f"regexp_replace({_DROP}, '(?is)<{_tag}\\b.*?</{_tag}\\s*>', ' ', 'g')"


@query("x2_html_text", f"SELECT page_id, substr({d.clean('t')}, 1, 200000) AS text FROM (SELECT page_id, regexp_replace({_DROP}, '<[^>]+>', ' ', 'g') AS t FROM pages)")
def x2(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", html.html_text(F.col("html")).alias("text"))


_BASE_ROOT = f"{d.part('url', 1)} || '://' || {d.part('url', 2)}"


_FRAMED = """CASE WHEN page_id % 3 = 0 THEN concat(html, '<a href="/icon/', page_id, '" title="T ', page_id, '"></a><a href="/img/', page_id, '"><img src="q" alt="I ', page_id,
    '"></a><!-- <a href="/no">no</a> --><object data="/obj/', page_id, '"></object><embed src="/emb/', page_id, '"><iframe title="F &amp; ', page_id, '" src="/frame/', page_id, '"></iframe><iframe></iframe>') ELSE html END"""
_ANCHORS = [f"regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g'), {Q(vocab.ANCHOR)}, {k})" for k in (1, 2)]
_LINKS = f"""SELECT page_id, seq, {_BASE_ROOT} || {_unescaped("trim(h, chr(34))")} AS link, {d.clean(_unescaped("regexp_replace(t, '<[^>]+>', ' ', 'g')"))} AS text
    FROM (SELECT page_id, url, unnest(range(len({_ANCHORS[0]}))) AS seq, unnest({_ANCHORS[0]}) AS h, unnest({_ANCHORS[1]}) AS t FROM pages)
    UNION ALL SELECT page_id, len({_ANCHORS[0]}) + k, {_BASE_ROOT} || p || page_id, CASE WHEN t = '' THEN '' ELSE t || page_id END
    FROM pages, (VALUES (0, '/icon/', 'T '), (1, '/img/', 'I '), (2, '/frame/', 'F & '), (4, '/emb/', ''), (5, '/obj/', '')) v(k, p, t) WHERE page_id % 3 = 0"""


@query("s14_links", f"SELECT page_id, CAST(min(seq) AS INT) AS seq, link, arg_min(text, seq) AS text FROM ({_LINKS}) GROUP BY page_id, link")
def s14(spark, sf_dir):
    return html.extract_links(_pages(spark, sf_dir).withColumn("html", F.expr(_FRAMED)), keep=("page_id",)).select("page_id", "seq", "link", "text")


@query("x9_confidence", f"SELECT id, CASE WHEN id % 5 = 3 THEN 0.40 WHEN id % 5 = 4 THEN 0.25 ELSE greatest(0, least(1, CAST(0.45 AS DOUBLE) + CAST(0.20 AS DOUBLE) * s + CAST(CASE WHEN body <> 'n/a' THEN 0.12 ELSE 0.06 END AS DOUBLE) + CAST(CASE WHEN body <> 'n/a' THEN 0.08 ELSE 0 END AS DOUBLE) + CAST(CASE WHEN id % 2 = 0 THEN 0.07 ELSE 0 END AS DOUBLE) + CAST(CASE WHEN id % 3 = 0 THEN 0.08 ELSE 0 END AS DOUBLE) + CAST(CASE WHEN line_default <> 'Unknown' THEN 0.03 ELSE 0 END AS DOUBLE) - CAST(CASE WHEN id % 7 = 0 THEN 0.10 ELSE 0 END AS DOUBLE) - CAST(CASE WHEN id % 11 = 0 THEN 0.10 ELSE 0 END AS DOUBLE))) END AS confidence FROM (SELECT *, CAST({d.doc_type(_STRONG, _WEAK, 'strength')} AS DOUBLE) AS s FROM ({_TITLES_DUCK}))")
def x9(spark, sf_dir):
    c, i = F.col, F.col("id")
    strength = classify.classify_document_type(c("url"), c("title"), c("body"))["strength"]
    body = F.when(c("body") == "n/a", F.lit("")).otherwise(c("body"))
    score = rows.confidence(i % 5 < 3, i % 5 == 3, strength, c("title"), body, F.when(i % 2 == 0, F.lit("x")).otherwise(F.lit("")), i % 3 == 0, c("line_default"), i % 7 == 0, i % 11 == 0)
    return views.titles(spark, sf_dir).select("id", score.alias("confidence"))


# --- deduplication ----------------------------------------------------------------------------------------------------


def _catalogue(spark, sf_dir):
    return rows.normalise_rows(views.rows(spark, sf_dir))


@query("d1_title_key", f"SELECT id, {d.title_key('title')} AS title_key FROM ({_TITLES_DUCK})")
def d1(spark, sf_dir):
    return views.titles(spark, sf_dir).select("id", text.title_key(F.col("title")).alias("title_key"))


_URL_CTE = f"n AS ({NORMALISED}), u AS (SELECT *, {d.canonical('document_url')} AS url_key FROM n)"
_RANKED = f"r AS (SELECT *, row_number() OVER (PARTITION BY url_key ORDER BY {d.WINNER}) AS place, count(*) OVER (PARTITION BY url_key) AS n_url FROM u)"
_NOTE = lambda n, tier, example: f"substr(CASE WHEN notes <> '' THEN notes || '; ' ELSE '' END || 'collapsed ' || CAST({n} - 1 AS VARCHAR) || ' near-duplicate URL(s) under the ''' || {tier} || ''' rule (e.g. ' || {example} || ')', 1, 1000)"
_EXAMPLE = "e AS (SELECT url_key, arg_min(document_url, seq) AS example FROM r WHERE place > 1 GROUP BY url_key)"
_UNIQUE = f"k AS (SELECT r.* REPLACE (CASE WHEN n_url > 1 THEN {_NOTE('n_url', Q('exact_url'), 'example')} ELSE notes END AS notes), n_url - 1 AS dropped_urls FROM r LEFT JOIN e USING (url_key) WHERE place = 1)"


@query("d2_exact_url", f"WITH {_URL_CTE}, {_RANKED}, {_EXAMPLE}, {_UNIQUE} SELECT seq, url_key, notes, dropped_urls AS n_dropped FROM k")
def d2(spark, sf_dir):
    return dedupe.collapse_urls(_catalogue(spark, sf_dir)).select("seq", "url_key", "notes", "n_dropped")


_KEYS = (
    "keys AS (SELECT seq, 0 AS tier, lower(payer_name) || chr(1) || content_hash_sha256 AS key FROM k WHERE content_hash_sha256 <> '' AND http_status = '200' "
    "UNION ALL SELECT seq, 1, lower(payer_name) || chr(1) || upper(trim(policy_number)) || chr(1) || document_type FROM k WHERE policy_number <> '' "
    f"UNION ALL SELECT seq, 2, lower(payer_name) || chr(1) || document_type || chr(1) || tk || chr(1) || file_type FROM (SELECT *, {d.title_key('document_title')} AS tk FROM k) WHERE tk <> '')"
)
_COMPONENTS = (
    "first AS (SELECT tier, key, min(seq) AS f FROM keys GROUP BY ALL), edge AS (SELECT DISTINCT seq AS a, f AS b, tier FROM keys JOIN first USING (tier, key) WHERE seq <> f), "
    "sym AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge), "
    "reach(a, b) AS (SELECT a, b FROM sym UNION SELECT r.a, s.b FROM reach r JOIN sym s ON r.b = s.a), "
    "comp AS (SELECT a AS seq, least(a, min(b)) AS component FROM reach GROUP BY a), "
    "strong AS (SELECT component, min(tier) AS t FROM edge JOIN comp ON edge.b = comp.seq GROUP BY component)"
)
_BASE = f"WITH RECURSIVE {_URL_CTE}, {_RANKED}, {_EXAMPLE}, {_UNIQUE}, {_KEYS}"


def _tier_query(tier: int) -> str:
    return f"{_BASE} SELECT seq, count(*) OVER (PARTITION BY key) AS n_sharing, min(seq) OVER (PARTITION BY key) AS first FROM keys WHERE tier = {tier}"


def _shared(spark, sf_dir, tier: int):
    kept = store(dedupe.collapse_urls(_catalogue(spark, sf_dir)))
    keyed = kept.select("seq", F.explode(dedupe.cluster_keys()).alias("k")).where(F.col("k.tier") == tier)
    sizes = keyed.groupBy("k.key").agg(F.count(F.lit(1)).alias("n_sharing"), F.min("seq").alias("first"))
    return keyed.select("seq", F.col("k.key").alias("key")).join(sizes, "key").select("seq", "n_sharing", "first")


@query("d3_hash", _tier_query(0))
def d3(spark, sf_dir):
    return _shared(spark, sf_dir, 0)


@query("d4_policy_no", _tier_query(1))
def d4(spark, sf_dir):
    return _shared(spark, sf_dir, 1)


@query("d5_title", _tier_query(2))
def d5(spark, sf_dir):
    return _shared(spark, sf_dir, 2)


@query("d6_winner", f"WITH n AS ({NORMALISED}) SELECT payer_name, document_type, arg_min(seq, place) AS seq FROM (SELECT *, row_number() OVER (PARTITION BY payer_name, document_type ORDER BY {d.WINNER}) AS place FROM n) GROUP BY ALL")
def d6(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("payer_name", "document_type").orderBy(*dedupe.winner_order())
    return _catalogue(spark, sf_dir).withColumn("place", F.row_number().over(w)).where("place = 1").select("payer_name", "document_type", "seq")


@query("d7_components", f"{_BASE}, {_COMPONENTS} SELECT k.seq, coalesce(component, k.seq) AS component, CAST(t AS INT) AS component_tier FROM k LEFT JOIN comp USING (seq) LEFT JOIN strong USING (component)")
def d7(spark, sf_dir):
    kept = store(dedupe.collapse_urls(_catalogue(spark, sf_dir)).drop("tier", "n_dropped"))
    return dedupe.components(kept, store).select("seq", "component", "component_tier")


_FINAL = (
    "c AS (SELECT k.*, coalesce(component, k.seq) AS component, CASE t WHEN 0 THEN 'content_hash' WHEN 1 THEN 'policy_number' WHEN 2 THEN 'title' END AS tier FROM k LEFT JOIN comp USING (seq) LEFT JOIN strong USING (component)), "
    f"c2 AS (SELECT c.* REPLACE (CAST(sum(dropped_urls) OVER (PARTITION BY component) AS BIGINT) AS dropped_urls), row_number() OVER (PARTITION BY component ORDER BY {d.WINNER}) AS p2, count(*) OVER (PARTITION BY component) AS n2 FROM c), "
    "e2 AS (SELECT component, arg_min(document_url, seq) AS example2 FROM c2 WHERE p2 > 1 GROUP BY component), "
    f"kept AS (SELECT c2.* REPLACE (CASE WHEN n2 > 1 THEN {_NOTE('n2', 'tier', 'example2')} ELSE notes END AS notes), n2 - 1 AS n_dropped FROM c2 LEFT JOIN e2 USING (component) WHERE p2 = 1)"
)


@query("d8_annotate", f"{_BASE}, {_COMPONENTS}, {_FINAL} SELECT seq, notes FROM kept WHERE n_dropped > 0")
def d8(spark, sf_dir):
    return dedupe.dedupe(_catalogue(spark, sf_dir), store).where("n_dropped > 0").select("seq", "notes")


@query("d_full", f"{_BASE}, {_COMPONENTS}, {_FINAL} SELECT {', '.join(vocab.COLUMNS)}, seq, dropped_urls, n_dropped, tier FROM kept")
def d_full(spark, sf_dir):
    return dedupe.dedupe(_catalogue(spark, sf_dir), store).select(*vocab.COLUMNS, "seq", "dropped_urls", "n_dropped", "tier")


@query("a3_dedupe_report", f"{_BASE}, {_COMPONENTS}, {_FINAL}, parts AS (SELECT payer_name, 'exact_url' AS tier, dropped_urls AS n FROM kept UNION ALL SELECT payer_name, tier, n_dropped FROM kept) SELECT 'tier' AS kind, tier AS name, CAST(sum(n) AS BIGINT) AS n FROM parts WHERE n > 0 GROUP BY tier UNION ALL SELECT 'payer', payer_name, CAST(sum(n) AS BIGINT) FROM parts WHERE n > 0 GROUP BY payer_name UNION ALL SELECT 'collapsed', '', CAST(sum(n) AS BIGINT) FROM parts WHERE n > 0 UNION ALL SELECT 'kept', '', count(*) FROM kept")
def a3(spark, sf_dir):
    return dedupe.dedupe_report(store(dedupe.dedupe(_catalogue(spark, sf_dir), store)))


@query("a10_duplicate_urls", f"SELECT {d.canonical('document_url')} AS document_url, count(*) AS count FROM ({NORMALISED}) GROUP BY 1 HAVING count(*) > 1")
def a10(spark, sf_dir):
    return report.duplicate_urls(_catalogue(spark, sf_dir).withColumn("document_url", urls.normalise_url(F.col("document_url"))))


# --- robots, sitemaps, enumeration ------------------------------------------------------------------------------------

ROBOTS = "User-agent: *\nDisallow: /fr/\nAllow: /fr/8*\nDisallow: /*.html$\nDisallow: /search?q=\nCrawl-delay: 45\n\nUser-agent: SpecialBot\nUser-agent: other\nAllow: /\nSitemap: https://a.example/s.xml\nFoo: bar\nno colon here\n"


OTHER_ROBOTS = "User-agent: SpecialBot\nAllow: /en/docs\n\nUser-agent: *\nDisallow: /en/\nAllow: /en/1\nDisallow: /search?q=*\nCrawl-delay: 2\nSitemap: https://b.example/s.xml\nSitemap: https://b.example/t.xml\n"


def _hosts(spark, sf_dir):
    """Hosts with robots.txt answers that differ: its text by the length of the host's name, and in every five lengths one refusal and one miss."""
    hosts = _pages(spark, sf_dir).select(urls.host(F.col("url")).alias("host")).distinct()
    n = F.length("host")
    answer = F.when(n % 5 == 4, F.lit(403)).when(n % 5 == 3, F.lit(404)).otherwise(F.lit(200))
    return hosts.withColumns({"text": F.when(n % 2 == 0, F.lit(ROBOTS)).otherwise(F.lit(OTHER_ROBOTS)), "status": answer})


def _robots(spark, sf_dir):
    return robots.parse_robots(_hosts(spark, sf_dir).select("host", "text"))


_HOST_LIST = f"(SELECT DISTINCT {d.host('url')} AS host FROM pages)"
_PARSED = (
    (0, 1, "agent", "*", 1), (0, 2, "rule_disallow", "/fr/", 1), (0, 3, "rule_allow", "/fr/8*", 1), (0, 4, "rule_disallow", "/*.html$", 1), (0, 5, "rule_disallow", "/search?q=", 1), (0, 6, "crawl_delay", "30.0", 1),
    (0, 8, "agent", "SpecialBot", 2), (0, 9, "agent", "other", 2), (0, 10, "rule_allow", "/", 2), (0, 11, "sitemap", "https://a.example/s.xml", 2), (0, 12, "unknown", "Foo: bar", 2), (0, 13, "unknown", "no colon here", 2),
    (1, 1, "agent", "SpecialBot", 1), (1, 2, "rule_allow", "/en/docs", 1), (1, 4, "agent", "*", 2), (1, 5, "rule_disallow", "/en/", 2), (1, 6, "rule_allow", "/en/1", 2), (1, 7, "rule_disallow", "/search?q=*", 2),
    (1, 8, "crawl_delay", "2.0", 2), (1, 9, "sitemap", "https://b.example/s.xml", 2), (1, 10, "sitemap", "https://b.example/t.xml", 2),
)
_PARSED_VALUES = ", ".join(f"({kind_of}, {line - 1}, {Q(kind)}, {Q(value)}, {group})" for kind_of, line, kind, value, group in _PARSED)


def _by_text(a, b):
    return f"CASE WHEN length(host) % 2 = 0 THEN {a} ELSE {b} END"


@query("s8_robots_parse", f"SELECT host, CAST(line AS INT) AS line, kind, value, CAST(g AS BIGINT) AS group_no FROM {_HOST_LIST} JOIN (VALUES {_PARSED_VALUES}) AS v(t, line, kind, value, g) ON length(host) % 2 = t")
def s8(spark, sf_dir):
    return _robots(spark, sf_dir).select("host", "line", "kind", "value", "group_no")


@query("j3_agent_group", f"SELECT host, CAST({_by_text(1, 2)} AS BIGINT) AS anyone, CAST({_by_text(2, 1)} AS BIGINT) AS special FROM {_HOST_LIST}")
def j3(spark, sf_dir):
    parsed = store(_robots(spark, sf_dir))
    return robots.choose_group(parsed, "docsift/0.1").withColumnRenamed("group_no", "anyone").join(robots.choose_group(parsed, "My specialbot 2").withColumnRenamed("group_no", "special"), "host")


_FULL_PATH = f"(CASE WHEN {d.part('url', 3)} = '' THEN '/' ELSE {d.part('url', 3)} END || CASE WHEN {d.part('url', 4)} = '' THEN '' ELSE '?' || {d.part('url', 4)} END)"
_RULE = (
    "CASE WHEN length(host) % 5 IN (3, 4) THEN '' WHEN length(host) % 2 = 0 THEN CASE WHEN p LIKE '/search?q=%' THEN 'Disallow: /search?q=' WHEN regexp_matches(p, '^/.*\\.html$') THEN 'Disallow: /*.html$' WHEN p LIKE '/fr/8%' THEN 'Allow: /fr/8*' WHEN p LIKE '/fr/%' THEN 'Disallow: /fr/' ELSE '' END "
    "ELSE CASE WHEN p LIKE '/search?q=%' THEN 'Disallow: /search?q=*' WHEN p LIKE '/en/1%' THEN 'Allow: /en/1' WHEN p LIKE '/en/%' THEN 'Disallow: /en/' ELSE '' END END"
)


@query("j2_robots_decision", f"SELECT page_id, length(host) % 5 <> 4 AND NOT starts_with(rule, 'Dis') AS allowed, rule AS matched_rule FROM (SELECT page_id, host, {_RULE} AS rule FROM (SELECT page_id, {d.host('url')} AS host, url_decode({_FULL_PATH}) AS p FROM pages))")
def j2(spark, sf_dir):
    hosts = _hosts(spark, sf_dir)
    answers = hosts.select(F.concat(F.lit("https://"), F.col("host"), F.lit("/robots.txt")).alias("url"), "status", F.encode("text", "UTF-8").alias("content"))
    rules = robots.rules_for(robots.parse_robots(hosts.select("host", "text")), "docsift/0.1")
    return robots.decide(_pages(spark, sf_dir).select("page_id", "url"), store(rules), keys=("page_id",), policies=store(robots.policies_of(answers))).select("page_id", "allowed", "matched_rule")


@query("a6_robots_summary", f"SELECT host, CAST(2 AS BIGINT) AS groups, CAST({_by_text(5, 4)} AS BIGINT) AS rules, CAST({_by_text(1, 2)} AS BIGINT) AS sitemaps, CAST({_by_text(30, 2)} AS DOUBLE) AS crawl_delay FROM {_HOST_LIST}")
def a6(spark, sf_dir):
    return robots.summary(store(_robots(spark, sf_dir)))


@query("f12_helpful_disallowed", f"SELECT host, '/search?q=' AS path, {_by_text(Q('Disallow: /search?q='), Q('Disallow: /search?q=*'))} AS rule FROM {_HOST_LIST}")
def f12(spark, sf_dir):
    return robots.helpful_disallowed(store(robots.rules_for(_robots(spark, sf_dir), "docsift/0.1"))).select("host", "path", "rule")


_SITEMAP = "'<urlset><url><loc> ' || url || '</loc><lastmod>2026-01-0' || CAST(page_id % 9 + 1 AS STRING) || '</lastmod></url><url ><loc><![CDATA[https://x.org/' || CAST(page_id AS STRING) || ']]></loc></url><url><loc>' || url || '</loc></url><loc>ftp://no</loc><loc>http://tail/' || CAST(page_id AS STRING) || '</loc>'"


@query("s11_sitemap", "SELECT page_id, CAST(s AS INT) AS seq, loc, lastmod FROM (SELECT page_id, 0 AS s, url AS loc, '2026-01-0' || CAST(page_id % 9 + 1 AS VARCHAR) AS lastmod FROM pages UNION ALL SELECT page_id, 1, 'https://x.org/' || CAST(page_id AS VARCHAR), '' FROM pages UNION ALL SELECT page_id, 2, 'http://tail/' || CAST(page_id AS VARCHAR), '' FROM pages)")
def s11(spark, sf_dir):
    files = spark.sql(f"SELECT page_id, {_SITEMAP} AS text FROM {{pages}}", **views.read(spark, sf_dir, "pages"))
    return sitemap.parse_sitemaps(files, keep=("page_id",)).select("page_id", "seq", "loc", "lastmod")


_ENUM = "SELECT p_partkey AS seq, p_brand AS payer_name, 'https://' || CASE WHEN p_size % 3 = 0 THEN 'a' ELSE 'b' END || '.example/policy/' || CAST(CAST(p_partkey + floor(p_partkey / 4) + 100 AS BIGINT) AS STRING) || '.pdf' AS document_url FROM {part}"
_ENUM_DUCK = _ENUM.replace("{part}", "part")
_GROUPED = (
    f"g AS (SELECT payer_name, regexp_extract(document_url, '^(.*/)[0-9]+', 1) AS prefix, '.pdf' AS suffix, list_sort(list(DISTINCT CAST(regexp_extract(document_url, '([0-9]+)\\.pdf$', 1) AS BIGINT))) AS numbers, min(seq) AS first FROM ({_ENUM_DUCK}) GROUP BY ALL), "
    "t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY payer_name ORDER BY len(numbers) DESC, first) AS place FROM g WHERE len(numbers) >= 3) WHERE place = 1)"
)


@query("a5_templates", f"WITH {_GROUPED} SELECT payer_name, prefix, suffix, CAST(len(numbers) AS INT) AS n, array_to_string(numbers, ',') AS numbers FROM t")
def a5(spark, sf_dir):
    found = enumeration.templates(spark.sql(_ENUM, **views.read(spark, sf_dir, "part")))
    return found.select("payer_name", "prefix", "suffix", F.size("numbers").alias("n"), F.array_join(F.transform("numbers", lambda x: x.cast("string")), ",").alias("numbers"))


@query("x18_candidates", f"WITH {_GROUPED}, w AS (SELECT *, numbers[1] AS lo, numbers[-1] AS hi, greatest(4, least(10, CASE WHEN numbers[-1] = numbers[1] THEN 8 ELSE numbers[-1] - numbers[1] END)) AS span FROM t), a AS (SELECT payer_name, prefix, suffix, list_slice(list_filter(list_concat(list_concat(range(hi + 1, hi + 1 + span), range(greatest(1, lo - span), lo)), range(lo, hi + 1)), lambda x: NOT list_contains(numbers, x)), 1, 20) AS wanted FROM w) SELECT payer_name, CAST(unnest(range(len(wanted))) AS INT) AS place, prefix || CAST(unnest(wanted) AS VARCHAR) || suffix AS url FROM a")
def x18(spark, sf_dir):
    found = enumeration.templates(spark.sql(_ENUM, **views.read(spark, sf_dir, "part")))
    return enumeration.candidates(found, 20).select("payer_name", "place", "url")


# --- counters, checkpoint joins, pacing -------------------------------------------------------------------------------

_STATS_DUCK = views.for_duck(views.STATS)
_COUNTED = "SELECT payer_name, count(*) FILTER (outcome IN ('ok', 'unrecognised', 'failed', 'challenged', 'gated', 'non_200')) AS attempted, count(*) FILTER (outcome = 'ok') AS found, count(*) FILTER (outcome IN ('failed', 'challenged', 'gated', 'non_200')) AS failed, count(*) FILTER (outcome = 'robots') AS skipped_robots, bool_or(outcome = 'challenged') AS blocked FROM (" + _STATS_DUCK + ") GROUP BY payer_name"


@query("a1_counters", _COUNTED)
def a1(spark, sf_dir):
    return report.counters(views.stats(spark, sf_dir))


@query("a2_summary_rollup", f"WITH c AS ({_COUNTED}), s AS (SELECT payer_name, attempted, found, failed, skipped_robots, failed % 3 AS dupes_collapsed FROM c) SELECT * FROM s UNION ALL SELECT 'TOTAL', CAST(sum(attempted) AS BIGINT), CAST(sum(found) AS BIGINT), CAST(sum(failed) AS BIGINT), CAST(sum(skipped_robots) AS BIGINT), CAST(sum(dupes_collapsed) AS BIGINT) FROM s")
def a2(spark, sf_dir):
    return report.with_totals(report.counters(views.stats(spark, sf_dir)).withColumn("dupes_collapsed", F.col("failed") % 3))


_VERDICT = "CASE WHEN blocked AND found = 0 THEN 'BLOCKED - automated access refused (see log for evidence)' WHEN blocked THEN 'partial - ' || CAST(found AS VARCHAR) || ' found before being blocked' WHEN status = 'failed' THEN 'FAILED - crawl error, see log' WHEN found = 0 AND failed > 0 THEN 'no live documents - ' || CAST(failed AS VARCHAR) || '/' || CAST(attempted AS VARCHAR) || ' discovered link(s) returned non-200; rows kept as evidence' WHEN found = 0 AND skipped_robots > 0 THEN 'no documents - ' || CAST(skipped_robots AS VARCHAR) || ' candidate(s) robots-disallowed' WHEN found = 0 THEN 'no documents - crawled successfully, nothing publishable found' ELSE 'ok' END"
_CASES = "SELECT o_orderkey, o_orderkey % 5 = 0 AS blocked, CASE WHEN o_orderkey % 7 < 5 THEN 0 ELSE o_orderkey % 7 END AS found, CASE WHEN o_orderkey % 3 = 0 THEN 'failed' ELSE 'done' END AS status, CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE o_orderkey % 4 END AS failed, o_orderkey % 9 AS attempted, o_orderkey % 4 AS skipped_robots FROM {orders}"


@query("x19_verdict", f"SELECT o_orderkey, {_VERDICT} AS outcome FROM ({_CASES.replace('{orders}', 'orders')})")
def x19(spark, sf_dir):
    return spark.sql(_CASES, **views.read(spark, sf_dir, "orders")).select("o_orderkey", report.verdict().alias("outcome"))


@query("j8_stats_merge", f"WITH c AS ({_COUNTED}), a AS (SELECT payer_name, attempted, found FROM c WHERE found % 2 = 0), b AS (SELECT payer_name, attempted + 1000 AS attempted, found + 1000 AS found FROM c WHERE attempted % 3 > 0) SELECT coalesce(a.payer_name, b.payer_name) AS payer_name, coalesce(a.attempted, b.attempted) AS attempted, coalesce(a.found, b.found) AS found FROM a FULL JOIN b ON a.payer_name = b.payer_name")
def j8(spark, sf_dir):
    all_ = report.counters(views.stats(spark, sf_dir))
    live = all_.where("found % 2 = 0").select("payer_name", "attempted", "found")
    kept = all_.where("attempted % 3 > 0").select("payer_name", (F.col("attempted") + 1000).alias("attempted"), (F.col("found") + 1000).alias("found"))
    return report.merge_stats(live, kept)


@query("j6_incremental_rows", "WITH i AS (SELECT doc_id AS seq, 'https://h.org/' || CAST(CAST(floor(doc_id / 3) AS BIGINT) AS VARCHAR) AS k FROM documents), e AS (SELECT 'https://h.org/' || CAST(doc_id * 2 AS VARCHAR) AS k FROM documents) SELECT k AS url_key, min(seq) AS seq FROM i WHERE k NOT IN (SELECT k FROM e) GROUP BY k")
def j6(spark, sf_dir):
    from docsift.sources.checkpoint import first_writer_wins

    docs = _documents(spark, sf_dir)
    key = lambda n: urls.normalise_url(F.concat(F.lit("HTTPS://h.org/"), n.cast("long").cast("string"), F.lit("#f"))).alias("url_key")
    return first_writer_wins(docs.select(key(F.floor(F.col("doc_id") / 3)), F.col("doc_id").alias("seq")), docs.select(key(F.col("doc_id") * 2)))


@query("f16_write_off", "WITH e AS (SELECT user_id % 50 AS host, ts, event_id, (event_type IN ('error', 'view', 'signup')) AS bad FROM events), i AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY host ORDER BY ts, event_id) AS isle FROM e), s AS (SELECT host, isle, count(*) FILTER (bad) AS n FROM i GROUP BY ALL) SELECT host, CAST(max(n) AS BIGINT) AS longest, max(n) >= 8 AS written_off FROM s GROUP BY host")
def f16(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select((F.col("user_id") % 50).alias("host"), "ts", "event_id", "event_type")
    return pacing.write_offs(events, F.col("event_type").isin("error", "view", "signup"), order=("ts", "event_id"))


@query("l1_budget", f"SELECT id, brand, place FROM (SELECT id, brand, row_number() OVER (PARTITION BY brand ORDER BY score DESC, id) AS place FROM (SELECT p_partkey AS id, p_brand AS brand, p_size * 0.5 AS score FROM part)) WHERE place <= 8")
def l1(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("brand").orderBy(F.desc("score"), "id")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), (F.col("p_size") * 0.5).alias("score"))
    return part.withColumn("place", F.row_number().over(w)).where("place <= 8").select("id", "brand", "place")


@query("s5_range", "SELECT c_custkey FROM customer WHERE c_custkey BETWEEN 1 AND 3 OR c_custkey = 8 OR c_custkey BETWEEN 5 AND 5")
def s5(spark, sf_dir):
    from docsift.sources.seeds import parse_range

    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return customer.where(F.col("c_custkey").isin(parse_range("1-3, 8,5-5", 100))).select("c_custkey")


@query("r1_token_bucket")
def r1(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    requests = events.select((F.col("user_id") % 50).alias("host"), F.col("event_id").alias("request_id"), F.col("ts").cast("timestamp").cast("double").alias("arrival_s"))
    return pacing.admit(requests, 0.001)


@query("g1_frontier")
def g1(spark, sf_dir):
    """Discovery over pages as a site: each host is a payer's, its pages answer for their URLs."""
    from docsift.operators import frontier

    pages = _pages(spark, sf_dir)
    h = urls.host(F.col("url"))
    hosts = pages.select(h.alias("hint_host")).distinct()
    payers = hosts.select(F.col("hint_host").alias("payer_name"), "hint_host", F.lit(1).alias("position"), F.array().cast("array<string>").alias("extra_hosts"), F.array(F.lit("/start")).alias("seed_paths"))
    path = F.regexp_replace(urls.path(F.col("url")), "^/", "")
    start = pages.groupBy(F.concat(F.lit("https://"), h, F.lit("/start")).alias("url")).agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit('<a href="/medical-policy/'), path, F.lit('.pdf">Policy</a>')))), "").alias("html"))
    site = start.unionByName(pages.select(F.concat(F.lit("https://"), h, F.lit("/medical-policy/"), path, F.lit(".pdf")).alias("url"), F.concat(F.lit("%PDF-"), F.col("html")).alias("html")))
    answers = site.select("url", F.lit(200).alias("status"), F.create_map(F.lit("content-type"), F.lit("text/html")).alias("headers"), F.encode("html", "UTF-8").alias("content"), F.col("url").alias("final_url"))
    rules = store(robots.rules_for(robots.parse_robots(hosts.select(F.col("hint_host").alias("host"), F.lit("User-agent: *\nDisallow: /medical-policy/fr/\n").alias("text"))), "docsift/0.1"))
    return frontier.discover(payers, store(answers), rules, store).select("payer_name", "url", "discovery_path", "origin", "priority", "outcome", "file_type")


@query("r6_stream_dedupe", f"SELECT DISTINCT {d.canonical('url')} AS url_key FROM ({_URLS_DUCK})")
def r6(spark, sf_dir):
    """pages as a stream, each canonical URL written once by an idempotent batch sink."""
    import uuid

    from docsift.streaming.twins import new_rows_sink

    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or _roots.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="docsift-checkpoint-"))
    root = f"{named.rstrip('/')}/docsift-stream/{uuid.uuid4().hex}"
    source = f"{sf_dir}/pages.parquet"
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).parquet(source if "." not in source.rsplit("/", 1)[-1] else f"{source}*")
    keyed = spark_urls(stream).select(urls.normalise_url(F.col("url")).alias("url_key"))
    running = keyed.writeStream.foreachBatch(new_rows_sink(f"{root}/rows")).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.read.schema("url_key string").parquet(f"{root}/rows")


def spark_urls(pages: DataFrame) -> DataFrame:
    """_URLS for a stream or a batch."""
    return pages.selectExpr("page_id", _URLS.split("SELECT page_id, ", 1)[1].rsplit(" FROM ", 1)[0])


@query("w8_event_windows", "SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def w8(spark, sf_dir):
    from docsift.streaming.twins import windowed_counts

    return windowed_counts(spark.read.parquet(f"{sf_dir}/events.parquet"))
