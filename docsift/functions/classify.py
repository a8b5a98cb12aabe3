"""Metadata from texts, titles and URLs: numbers, types, lines of business, states, scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsift.functions import vocab
from docsift.functions.text import clean_text, contains_any, normalise_multi_enum
from docsift.functions.urls import path

# Phrases up to this length are weak evidence and don't count in bodies.
_WEAK = 8

# A code after a slash and before a slash, hyphen or dot, or between a hyphen or underscore and a dot.
_CODES = "|".join(c.lower() for c in vocab.USPS_CODES)
_STATE_CODE = rf"(?<=/)(?:{_CODES})(?=[/\-.])|(?<=[_\-])(?:{_CODES})(?=\.)"


def extract_policy_number(text: Column, title: Column, url: Column) -> Column:
    """The first acceptable number of the body's head, the title and the URL, pattern by pattern."""
    tries = []
    for source in (F.substring(F.coalesce(text, F.lit("")), 1, 8000), F.coalesce(title, F.lit("")), F.coalesce(url, F.lit(""))):
        for pattern in vocab.POLICY_NUMBER_PATTERNS:
            value = F.regexp_replace(clean_text(F.regexp_extract(source, pattern, 1)), r"^[.,;:\-_/]+|[.,;:\-_/]+\z", "")
            fits = (F.length(value) >= 3) & (F.length(value) <= 32) & ~value.rlike(r"^(?:19|20)\d{2}\z")
            tries.append(F.when(fits, F.when(value.rlike(r"^\p{ASCII}*\z"), F.upper(value)).otherwise(value)))
    return F.coalesce(*tries, F.lit(""))


def classify_document_type(url: Column, title: Column, text: Column) -> Column:
    """struct(document_type, strength) by ordered phrases, title and URL before the body's head."""
    strong = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(url, F.lit(""))))
    weak = F.lower(F.substring(F.coalesce(text, F.lit("")), 1, 4000))
    pair = lambda kind, strength: F.struct(F.lit(kind).alias("document_type"), F.lit(strength).alias("strength"))
    tries = []
    for kind, phrases in vocab.TYPE_RULES:
        # the strength is that of the first phrase that occurs
        tries.append(F.when(contains_any(strong, phrases), F.coalesce(*[F.when(F.contains(strong, F.lit(p)), pair(kind, 0.9 if len(p) > _WEAK else 0.65)) for p in phrases])))
    for kind, phrases in vocab.TYPE_RULES:
        if long := [p for p in phrases if len(p) > _WEAK]:
            tries.append(F.when(contains_any(weak, long), pair(kind, 0.5)))
    return F.coalesce(*tries, pair("other", 0.2))


def infer_line_of_business(url: Column, title: Column, text: Column, default: Column) -> Column:
    strong = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(url, F.lit(""))))
    weak = F.lower(F.substring(F.coalesce(text, F.lit("")), 1, 6000))
    hits = lambda c: F.filter(F.array(*[F.when(contains_any(c, phrases), F.lit(name)) for name, phrases in vocab.LOB_RULES]), lambda x: x.isNotNull())
    named, hinted = hits(strong), hits(weak)
    return (
        F.when(F.size(named) >= 2, F.lit("Multiple"))
        .when(F.size(named) == 1, F.get(named, F.lit(0)))
        .when(F.size(hinted) >= 3, F.lit("Multiple"))
        .when(F.size(hinted) == 1, F.get(hinted, F.lit(0)))
        .when(default.isin(*vocab.LINE_OF_BUSINESS), default)
        .otherwise(F.lit("Unknown"))
    )


def infer_state_or_region(url: Column, title: Column, default: Column) -> Column:
    """State names in title or URL, then codes in the URL (in code order), six at most; else National; else the default."""
    low = F.lower(F.coalesce(url, F.lit("")))
    text = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(url, F.lit(""))))
    named = [F.when(F.contains(text, F.lit(name)), F.lit(code)) for name, code in vocab.STATE_NAMES]
    codes = F.upper(F.concat_ws("|", *named, F.sort_array(F.regexp_extract_all(low, F.lit(_STATE_CODE), F.lit(0)))))
    found = F.array_join(F.slice(F.array_distinct(F.split(codes, r"\|")), 1, 6), "|")
    national = contains_any(text, ("national", "all states"))
    return F.when(found != "", found).when(national, F.lit("National")).otherwise(normalise_multi_enum(default, vocab.STATE_OR_REGION))


def score_candidate(url: Column, anchor: Column) -> Column:
    """Crawl priority: weights and penalties of phrases, PDFs and depth."""
    low = F.lower(F.concat_ws(" ", url, F.coalesce(anchor, F.lit(""))))
    score = F.lit(1.0) + F.when(F.lower(path(url)).endswith(".pdf"), F.lit(1.2)).otherwise(F.lit(0.0))
    for phrase, weight in vocab.SCORE_WEIGHTS:
        score = score + F.when(F.contains(low, F.lit(phrase)), F.lit(weight)).otherwise(F.lit(0.0))
    for phrase, penalty in vocab.SCORE_PENALTIES:
        score = score - F.when(F.contains(low, F.lit(phrase)), F.lit(penalty)).otherwise(F.lit(0.0))
    slashes = F.length(path(url)) - F.length(F.replace(path(url), F.lit("/"), F.lit("")))
    return F.bround(F.greatest(F.lit(0.0), score + F.least(F.lit(0.4), slashes * F.lit(0.05))), 3)


def plausible_pdf_title(title: Column) -> Column:
    low = F.lower(F.coalesce(title, F.lit("")))
    bad = low.startswith("microsoft word -") | low.startswith("microsoft powerpoint -") | low.rlike(r"^[\w\-. ]+\.(?:docx?|pdf|xlsx?|pptx?|rtf|tmp)\z") | low.isin(*vocab.GENERIC_PDF_TITLES)
    return F.length(low).between(6, 300) & ~bad


def verify_enumerated(title: Column, file_type: Column, policy_number: Column, document_type: Column) -> Column:
    """Whether an enumerated find is a document: no soft 404, and a binary, or a page with a substantive title and a number or type."""
    low = F.lower(clean_text(title))
    return ~contains_any(low, vocab.SOFT_404_MARKERS) & (file_type.isin("pdf", "docx", "doc", "xlsx", "xls") | ((F.length(low) >= 8) & ((policy_number != "") | (document_type != "other"))))


def helpful_disallow(rule: Column) -> Column:
    low = F.lower(rule)
    return contains_any(low, vocab.HELPFUL_BLOCKED_HINTS) & ~contains_any(low, vocab.NEVER_HELPFUL_HINTS)


def document_types() -> tuple[str, ...]:
    """Types in order of precedence, the default last."""
    return (*[kind for kind, _ in vocab.TYPE_RULES], "other")


def check_vocabularies() -> None:
    """Every rule's outcome is a member of its enumeration."""
    assert {k for k, _ in vocab.TYPE_RULES} < set(vocab.DOCUMENT_TYPE)
    assert {k for k, _ in vocab.LOB_RULES} < set(vocab.LINE_OF_BUSINESS)
    assert {c for _, c in vocab.STATE_NAMES} < set(vocab.STATE_OR_REGION)


