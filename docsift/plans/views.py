"""Catalogue-like views over the generic tables, in SQL that both engines read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Rows as a crawl would leave them, with odd cases dealt by id. Copies of one text share a hash.
ROWS = """
SELECT d.doc_id AS seq, d.lang AS payer_name, d.source AS payer_alias,
  CASE d.doc_id % 5 WHEN 0 THEN 'PA|WV|PA' WHEN 1 THEN 'National' WHEN 2 THEN 'XX|NY' WHEN 3 THEN ' NJ | NY ' ELSE '' END AS state_or_region,
  CASE d.doc_id % 4 WHEN 0 THEN 'Medicare' WHEN 1 THEN ' Commercial ' WHEN 2 THEN 'bogus' ELSE 'N/A' END AS line_of_business,
  'Topic ' || CAST(d.doc_id % 211 AS STRING) || ' treatment ' || d.source || CASE d.doc_id % 3 WHEN 0 THEN ' (Revised 2024)' WHEN 1 THEN ' - Medical Policy' ELSE ' Effective 03/01/2026' END AS document_title,
  CASE d.lang WHEN 'en' THEN 'medical_policy' WHEN 'fr' THEN 'bulletin' WHEN 'de' THEN 'formulary' ELSE 'unheard_of' END AS document_type,
  CASE d.doc_id % 4 WHEN 0 THEN 'https://WWW.' ELSE 'https://www.' END || d.lang || '.example.com/policies/' || CAST(d.doc_id - d.doc_id % 2 AS STRING) || '.pdf' || CASE d.doc_id % 3 WHEN 0 THEN '?utm_source=x' WHEN 1 THEN '#top' ELSE '' END AS document_url,
  'https://www.' || d.source || '.example.com/' AS source_page_url,
  CASE WHEN d.doc_id % 17 = 0 THEN '' ELSE 'sitemap > /policies' END AS discovery_path,
  CASE d.doc_id % 3 WHEN 0 THEN 'PDF' WHEN 1 THEN 'html' ELSE 'zip' END AS file_type,
  CASE WHEN d.doc_id % 7 = 0 THEN 'MP-' || CAST(d.doc_id % 91 AS STRING) ELSE '-' END AS policy_number,
  CASE WHEN d.doc_id % 6 = 0 THEN '' WHEN d.doc_id % 6 = 1 THEN '03/' || CAST(1 + d.doc_id % 28 AS STRING) || '/2025' ELSE '2026-01-' || CAST(10 + d.doc_id % 19 AS STRING) END AS effective_date,
  CASE WHEN d.doc_id % 5 = 0 THEN 'March ' || CAST(1 + d.doc_id % 28 AS STRING) || ', 2024' ELSE 'TBD' END AS last_updated_date,
  CASE WHEN d.doc_id % 13 = 0 THEN '404' ELSE '200' END AS http_status, d.text AS body,
  CAST(length(d.text) AS STRING) AS file_size_bytes, CASE WHEN d.doc_id % 29 = 0 THEN 'yes' ELSE 'N' END AS requires_auth, 'static' AS render_mode,
  CASE d.doc_id % 3 WHEN 0 THEN 'sitemap|regex|sitemap' WHEN 1 THEN 'css_selector' ELSE 'guess' END AS extraction_method,
  CASE coalesce(l.quality, 2) WHEN 1 THEN '0.92' WHEN 0 THEN '0.41' ELSE '1.5' END AS confidence_score,
  '2026-01-02T03:04:05Z' AS scrape_timestamp_utc, CASE WHEN d.doc_id % 2 = 0 THEN 'seen' ELSE 'none' END AS notes
FROM {documents} d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM {labels} GROUP BY doc_id) l ON d.doc_id = l.doc_id
"""

#: Titles, URLs and texts with the domain's words, dealt by part.
_PHRASES = ("Prior Authorization List", "Exception Request Form", "Formulary 2026", "Specialty Drug Summary", "Pharmacy Policy MP-042", "Provider Manual", "Network Bulletin", "Clinical Guideline CS123.045", "Medical Policy: Imaging", "Medicare and Medicaid support", "Ohio commercial exchange", "West Virginia tricare notes")
_BODIES = ("Policy number: AB1234. Effective date: 03/01/2026. Last reviewed January 5, 2026.", "Applies to medicare members with coverage determination.", "No numbers here, revised 2/3/24.", "See 2024-0031 and medicaid, marketplace, fehb.", "Coverage rationale and hcpcs, effective 5 March 2026.", "n/a")
_PATHS = ("/docs/medical-policy_CS{n}.pdf", "/news/item-{n}", "/content/dam/coverage/file{n}", "/view?docid={n}", "/img/logo{n}.png", "/oh/plans/a{n}.html", "/assets/x_{n}.docx", "/provider-manual/archive/{n}/", "/download/polic{n}", "/careers/medical-policy-{n}", "/PA-list_2026%20{n}.xlsx", "/")


def _case(column: str, values, concat=lambda v: "'" + v.replace("'", "''") + "'") -> str:
    return f"CASE {column} % {len(values)} " + " ".join(f"WHEN {k} THEN {concat(v)}" for k, v in enumerate(values)) + " END"


def _numbered(v: str) -> str:
    a, _, b = v.partition("{n}")
    return f"'{a}' || CAST(p_partkey AS STRING) || '{b}'" if "{n}" in v else f"'{v}'"


TITLES = f"""
SELECT p_partkey AS id, {_case("p_partkey", _PHRASES)} || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE ' ' || p_brand END AS title, {_case("(p_partkey * 7 + p_size)", _BODIES)} AS body,
  'https://' || CASE p_partkey % 3 WHEN 0 THEN 'www.example.com' WHEN 1 THEN 'oh.example.org' ELSE 'Docs.Example.co.uk' END || ({_case("(p_partkey * 5 + p_size)", _PATHS, _numbered)}) AS url,
  CASE p_partkey % 4 WHEN 0 THEN 'Medicare' WHEN 1 THEN 'nonsense' ELSE 'Unknown' END AS line_default, CASE p_partkey % 3 WHEN 0 THEN 'PA|XX' ELSE '' END AS state_default
FROM {{part}}
"""

#: Counters per host over the events table, which stands for fetches.
STATS = """
SELECT 'payer' || CAST(user_id % 97 AS STRING) AS payer_name,
  CASE event_type WHEN 'error' THEN 'non_200' WHEN 'purchase' THEN 'ok' WHEN 'click' THEN 'ok' ELSE CASE event_id % 5 WHEN 0 THEN 'robots' WHEN 1 THEN 'unrecognised' WHEN 2 THEN 'failed' ELSE 'ok' END END AS outcome, event_id AS seq
FROM {events}
"""


def read(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROWS with the hash of its body."""
    out = spark.sql(ROWS, **read(spark, sf_dir, "documents", "labels"))
    return out.selectExpr("*", "sha2(body, 256) AS content_hash_sha256").drop("body")


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TITLES, **read(spark, sf_dir, "part"))


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(STATS, **read(spark, sf_dir, "events"))


def for_duck(sql: str) -> str:
    """A view's text with plain table names."""
    for name in ("documents", "labels", "part", "events"):
        sql = sql.replace("{" + name + "}", name)
    return sql


DUCK_ROWS = f"SELECT * EXCLUDE (body), sha256(body) AS content_hash_sha256 FROM ({for_duck(ROWS)})"
