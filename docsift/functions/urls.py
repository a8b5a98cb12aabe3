"""URL functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsift.functions import vocab
from docsift.functions.text import clean_text, contains_any, percent_decode, strip

SPLIT = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def part(url: Column, k: int) -> Column:
    """1 scheme, 2 authority, 3 path, 4 query, 5 fragment; empty where absent."""
    return F.regexp_extract(url, SPLIT, k)


def host(url: Column) -> Column:
    """Lower-case host without user and port."""
    return F.lower(F.regexp_extract(part(url, 2), r"(?:.*@)?(\[[^\]]*\]|[^:]*)", 1))


def path(url: Column) -> Column:
    return part(url, 3)


def ends_with_any(c: Column, endings) -> Column:
    return c.rlike("(?:" + "|".join(rf"\Q{e}\E" for e in endings) + r")\z")


def normalise_url(url: Column) -> Column:
    """Canonical form for comparison: case, default ports, index files, tracking parameters, order of parameters."""
    text = strip(F.coalesce(url, F.lit("")))
    scheme = F.lower(F.when(part(text, 1) == "", F.lit("https")).otherwise(part(text, 1)))
    name = host(text)
    port = F.regexp_replace(F.regexp_extract(part(text, 2), r":(\d+)$", 1), r"^0+(?=.)", "")
    default = ((scheme == "https") & (port == "443")) | ((scheme == "http") & (port == "80")) | port.isin("", "0")
    p = F.when(path(text) == "", F.lit("/")).otherwise(path(text))
    for index in vocab.INDEX_FILE_NAMES:
        p = F.regexp_replace(p, rf"(?i)(?<=/)\Q{index}\E\z", "")
    p = F.when(F.length(p) > 1, F.regexp_replace(p, r"/+\z", "")).otherwise(p)
    p = F.regexp_replace(p, r"/{2,}", "/")
    p = F.when(p == "", F.lit("/")).otherwise(p)
    junk = "^(?:" + "|".join(rf"\Q{j}\E" for j in vocab.TRACKING_PREFIXES) + ")"
    kept = F.array_join(F.array_sort(F.filter(F.split(part(text, 4), "&"), lambda q: (q != "") & ~F.lower(F.substring_index(q, "=", 1)).rlike(junk))), "&")
    full = F.concat(scheme, F.lit("://"), name, F.when(default, F.lit("")).otherwise(F.concat(F.lit(":"), port)), p, F.when(kept == "", F.lit("")).otherwise(F.concat(F.lit("?"), kept)))
    return F.when(name == "", text).otherwise(full)


def registrable_domain(name: Column) -> Column:
    """Last two labels of a host, three under the listed two-label suffixes."""
    h = F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"^\.+|\.+$", "")
    two = F.substring_index(h, ".", -2)
    return F.when(two.isin(*vocab.TWO_LABEL_TLDS), F.substring_index(h, ".", -3)).otherwise(two)


def in_scope(name: Column, hint_host: Column, extra_hosts: Column) -> Column:
    """Same registrable domain as the hint host, or equal to, under or akin to an extra host."""
    h = F.lower(F.coalesce(name, F.lit("")))
    own = registrable_domain(hint_host)
    extra = F.exists(extra_hosts, lambda e: (F.trim(e) != "") & ((h == F.lower(F.trim(e))) | F.endswith(h, F.concat(F.lit("."), F.lower(F.trim(e)))) | (registrable_domain(h) == registrable_domain(F.lower(F.trim(e))))))
    return (h != "") & (((own != "") & (registrable_domain(h) == own)) | extra)


def _without_dots(p: Column) -> Column:
    """Dot segments of an absolute path resolved."""
    parts = F.split(p, "/")
    last = F.element_at(parts, -1)
    kept = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(s == ".", done).otherwise(F.array_append(done, s)),
    )
    closing = last.isin(".", "..") & (F.size(kept) > 0)
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(closing, F.lit("/")).otherwise(F.lit("")))


def resolve(base: Column, href: Column) -> Column:
    """href against base, without its fragment; null for what is no http(s) link."""
    h = F.coalesce(href, F.lit(""))
    skipped = "^(?i:" + "|".join(rf"\Q{s}\E" for s in vocab.SKIPPED_SCHEMES) + ")"
    root = F.concat(part(base, 1), F.lit("://"), part(base, 2))
    folder = F.regexp_replace(path(base), r"[^/]*\z", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    own = part(h, 3)
    tail = F.when(F.contains(F.substring_index(h, "#", 1), F.lit("?")) & (part(h, 4) != ""), F.concat(F.lit("?"), part(h, 4))).otherwise(F.lit(""))
    target = (
        F.when(h.rlike(r"(?i)^https?://"), F.concat(F.lower(part(h, 1)), F.lit("://"), part(h, 2), F.when((own == "") | ~own.rlike(r"(?:^|/)\.\.?(?:/|\z)"), own).otherwise(_without_dots(own)), tail))
        .when(h.startswith("//"), F.concat(part(base, 1), F.lit("://"), part(h, 2), own, tail))
        .when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(None).cast("string"))
        .when(h.startswith("/"), F.concat(root, _without_dots(own), tail))
        .when(own == "", F.concat(root, path(base), F.when(tail != "", tail).when(part(base, 4) != "", F.concat(F.lit("?"), part(base, 4))).otherwise(F.lit(""))))
        .otherwise(F.concat(root, _without_dots(F.concat(folder, own)), tail))
    )
    return F.when((h == "") | h.rlike(skipped), F.lit(None).cast("string")).when(target.rlike(r"(?i)^https?://"), target)


def title_from_url(url: Column) -> Column:
    """Readable title of a URL's last segment; empty under three characters."""
    stem = F.substring_index(path(url), "/", -1)
    stem = F.regexp_replace(stem, r"(?i)(?:\.pdf|\.docx?|\.xlsx?|\.rtf)\z", "")
    stem = clean_text(F.regexp_replace(F.regexp_replace(stem, r"[_\-+.]+", " "), r"%[0-9A-Fa-f]{2}", " "))
    cased = F.transform(F.split(stem, " "), lambda w: F.when(((w == F.upper(w)) & (w != F.lower(w))) | w.rlike(r"\d"), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, F.lit(2), F.length(w))))))
    return F.when(F.length(stem) < 3, F.lit("")).otherwise(F.substring(F.array_join(cased, " "), 1, 200))


def sanitize_filename(name: Column, fallback: str = "document", limit: int = 90) -> Column:
    """A file name for all common systems; fallback when nothing is left."""
    text = F.regexp_replace(strip(percent_decode(F.coalesce(name, F.lit("")))), r'[<>:"/\\|?*\x00-\x1f]+', "_")
    text = F.regexp_replace(F.regexp_replace(text, r"[\s\x{85}\p{Z}]+", "_"), r"_{2,}", "_")
    text = F.regexp_replace(text, r"^[._ ]+|[._ ]+\z", "")
    guarded = F.when(F.lower(F.substring_index(text, ".", 1)).isin(*vocab.RESERVED_NAMES), F.concat(F.lit("file_"), text)).otherwise(text)
    return F.when(text == "", F.lit(fallback)).otherwise(F.substring(guarded, 1, limit))


def sanitize_dirname(name: Column) -> Column:
    return F.substring(sanitize_filename(name, "unknown_payer"), 1, 60)


def archive_path(payer: Column, url: Column, digest: Column, file_type: Column) -> Column:
    """Folder and file of an archived body: a readable stem, ten digits of its hash (of the URL's without one), the type's suffix."""
    p = path(url)
    last = percent_decode(F.substring_index(p, "/", -1))
    stem = F.regexp_replace(last, r"(?i)(?:\.pdf|\.html?|\.docx?|\.xlsx?|\.aspx)\z", "")
    segments = F.filter(F.split(p, "/"), lambda s: s != "")
    near = F.array_join(F.slice(segments, F.greatest(F.size(segments) - 2, F.lit(1)), 3), "_")
    stem = F.when((F.length(stem) < 3) | stem.rlike(r"^\d+$"), F.when(near == "", F.lit("document")).otherwise(near)).otherwise(stem)
    short = F.substring(F.when(F.coalesce(digest, F.lit("")) != "", digest).otherwise(F.sha2(url, 256)), 1, 10)
    suffix = F.when(file_type.isin("html", "pdf", "doc", "docx", "xls", "xlsx"), F.concat(F.lit("."), file_type)).otherwise(F.lit(".bin"))
    return F.concat(sanitize_dirname(payer), F.lit("/"), sanitize_filename(stem), F.lit("_"), short, suffix)


def robots_path(url: Column) -> Column:
    """Path and query that robots rules see: decoded, with a leading slash."""
    full = F.when(F.contains(url, F.lit("://")), F.concat(F.when(path(url) == "", F.lit("/")).otherwise(path(url)), F.when(part(url, 4) == "", F.lit("")).otherwise(F.concat(F.lit("?"), part(url, 4))))).otherwise(F.when(url == "", F.lit("/")).otherwise(url))
    return percent_decode(F.when(full.startswith("/"), full).otherwise(F.concat(F.lit("/"), full)))


def page_label(url: Column) -> Column:
    p = F.when(path(url) == "", F.lit("/")).otherwise(path(url))
    return F.when(F.length(p) <= 60, p).otherwise(F.concat(F.substring(p, 1, 57), F.lit("...")))


def anchor_selector(href: Column) -> Column:
    p = F.lower(path(href))
    out = F.lit("anchor[href]")
    for ending in (".xls", ".xlsx", ".doc", ".docx", ".pdf"):
        out = F.when(p.endswith(ending), F.lit(f"anchor[href$='{ending}']")).otherwise(out)
    return out


def looks_like_document_url(url: Column) -> Column:
    low = F.lower(url)
    p = path(low)
    return ~ends_with_any(p, vocab.NEGATIVE_EXTENSIONS) & (
        ends_with_any(p, vocab.DOCUMENT_EXTENSIONS) | contains_any(part(low, 4), vocab.DOCUMENT_QUERY_HINTS) | (contains_any(p, vocab.ASSET_ROUTES) & contains_any(low, vocab.ASSET_STEMS))
    )


def looks_like_policy_index(text: Column) -> Column:
    low = F.lower(clean_text(text))
    return (low != "") & (F.length(low) <= 120) & contains_any(low, vocab.INDEX_TEXT_HINTS)


def has_policy_hint(url: Column) -> Column:
    return contains_any(F.lower(url), vocab.POLICY_PATH_HINTS)


def is_noise(url: Column) -> Column:
    low = F.lower(url)
    return F.when(contains_any(low, vocab.NOISE_PATH_HINTS), ~has_policy_hint(low)).otherwise(ends_with_any(low, vocab.NEGATIVE_EXTENSIONS))


def is_html_policy_page(url: Column, body: Column) -> Column:
    low = F.lower(F.substring(F.coalesce(body, F.lit("")), 1, 60000))
    hits = sum((F.contains(low, F.lit(m)).cast("int") for m in vocab.HTML_POLICY_MARKERS), F.lit(0))
    return has_policy_hint(url) & (hits >= 2)
