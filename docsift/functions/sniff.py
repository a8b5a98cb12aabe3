"""What a response is: magic bytes, file type, bot walls, login gates, text decoding."""

from __future__ import annotations

from encodings.aliases import aliases
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsift.functions import vocab
from docsift.functions.text import contains_any, first_of
from docsift.functions.urls import path


def sniff_kind(content: Column) -> Column:
    """Coarse kind from the first bytes: pdf, ole, zip, doc, xml, html or empty."""
    head = F.substring(content, 1, 2048)
    code = F.hex(F.substring(content, 1, 8))
    kind = F.lit("")
    text = F.lower(F.substring(F.regexp_replace(F.decode(head, "ISO-8859-1"), r"^[ \t\n\r\x0b\f]+", ""), 1, 600))
    kind = F.when(contains_any(text, ("<html", "<!doctype html")), F.lit("html")).otherwise(kind)
    kind = F.when(text.startswith("<?xml") | text.startswith("<urlset") | text.startswith("<sitemapindex"), F.lit("xml")).otherwise(kind)
    for prefix, name in reversed(vocab.MAGIC_PREFIXES):
        kind = F.when(code.startswith(prefix), F.lit(name)).otherwise(kind)
    return F.when(F.coalesce(F.length(content), F.lit(0)) == 0, F.lit("")).otherwise(kind)


def content_type(header: Column) -> Column:
    return F.lower(F.trim(F.substring_index(F.coalesce(header, F.lit("")), ";", 1)))


def charset(header: Column) -> Column:
    return F.lower(F.trim(F.regexp_extract(F.coalesce(header, F.lit("")), r'(?i);\s*charset\s*=\s*"?([^";]*)', 1)))


#: Bytes 128 to 159 as Windows-1252 reads them, where it does.
_C1 = "".join(chr(b) for b in range(128, 160) if bytes([b]).decode("cp1252", "ignore"))
_WESTERN = "".join(bytes([ord(c)]).decode("cp1252") for c in _C1)


def _western(content: Column) -> Column:
    return F.translate(F.decode(content, "ISO-8859-1"), _C1, _WESTERN)


_HIGH = "".join(map(chr, range(128, 256)))
#: Single-byte codecs that pages declare.
_CODECS = ("latin_1", "koi8_r", "koi8_u", "mac_roman", *(f"cp{k}" for k in range(1250, 1259)), *(f"iso8859_{k}" for k in range(2, 17) if k != 12))


@cache
def _tables() -> dict[str, str]:
    """By every name of a single-byte codec: what bytes 128 to 255 stand for, U+FFFD where for nothing."""
    table = {c: "".join(bytes([b]).decode(c, "replace") for b in range(128, 256)) for c in _CODECS}
    return table | {name: table[c] for name, c in aliases.items() if c in table}


def decode_text(content: Column, declared: Column | None = None) -> Column:
    """Text by the declared charset where it is a single-byte one that has all bytes, else UTF-8 where valid, else Windows-1252; other declared charsets count as none."""
    utf8 = F.try_validate_utf8(content.cast("string"))
    text = F.coalesce(utf8, _western(content), F.lit(""))
    if declared is None:
        return text
    tables = F.create_map(*[F.lit(x) for pair in _tables().items() for x in pair])
    name = F.regexp_replace(F.lower(F.coalesce(declared, F.lit(""))), r"[^a-z0-9.]+", "_")
    own = F.call_function("translate", F.decode(content, "ISO-8859-1"), F.lit(_HIGH), F.try_element_at(tables, name))
    return F.coalesce(F.when(~F.contains(own, F.lit("\ufffd")), own), text)


def extension(url: Column) -> Column:
    p = path(url)
    last = F.lower(F.substring_index(p, ".", -1))
    return F.when(F.contains(p, F.lit(".")) & (F.length(last) <= 5), last).otherwise(F.lit(""))


def detect_file_type(content: Column, header: Column, url: Column) -> Column:
    """Magic bytes first, then the content type, then the suffix."""
    kind, kind_of, ext = sniff_kind(content), content_type(header), extension(url)
    office = lambda x, y, a, ax, b, bx: F.when(F.contains(kind_of, F.lit(x)) | ext.isin(*ax), F.lit(a)).when(F.contains(kind_of, F.lit(y)) | ext.isin(*bx), F.lit(b)).otherwise(F.lit("other"))
    named = F.coalesce(*[F.when(kind_of == k, F.lit(v)) for k, v in vocab.CONTENT_TYPES])
    by_suffix = F.when(ext.isin("pdf", "html", "doc", "docx", "xls", "xlsx"), ext).when(ext == "htm", F.lit("html")).otherwise(F.lit("other"))
    return (
        F.when(kind == "pdf", F.lit("pdf"))
        .when(kind == "zip", office("spreadsheet", "wordprocessing", "xlsx", ("xlsx", "xlsm"), "docx", ("docx", "docm")))
        .when(kind == "ole", office("excel", "word", "xls", ("xls", "xlt"), "doc", ("doc", "dot")))
        .when(kind.isin("html", "xml"), F.lit("html"))
        .otherwise(F.coalesce(named, by_suffix))
    )


def _body(content: Column) -> Column:
    return F.lower(decode_text(F.substring(content, 1, 20000)))


def challenge(status: Column, headers: Column, content: Column) -> Column:
    """Evidence of a bot wall, empty without: status, header, then body markers in list order."""
    header = lambda name: F.coalesce(F.try_element_at(headers, F.lit(name)), F.lit(""))
    joined = F.lower(F.concat_ws(" ", *[header(n) for n in ("server", "cf-mitigated", "x-iinfo", "x-datadome")]))
    listed = F.exists(F.map_keys(headers), lambda k: F.lower(k) == "cf-mitigated")
    return (
        F.when(status.isin(*vocab.BLOCK_STATUS), F.concat(F.lit("http_"), status.cast("string")))
        .when(F.coalesce(listed, F.lit(False)), F.lit("cloudflare_challenge_header"))
        .when(F.contains(joined, F.lit("captcha")), F.lit("captcha_header"))
        .when(~sniff_kind(content).isin("html", ""), F.lit(""))
        .otherwise(F.coalesce(first_of(_body(content), vocab.CHALLENGE_MARKERS), F.lit("")))
    )


def auth_gate(status: Column, content: Column, final_url: Column) -> Column:
    """Evidence of a login gate, empty without."""
    fragment = first_of(F.lower(final_url), vocab.AUTH_FRAGMENTS)
    return (
        F.when(status.isin(401, 407), F.concat(F.lit("http_"), status.cast("string")))
        .when(~sniff_kind(content).isin("html", ""), F.lit(""))
        .otherwise(F.coalesce(first_of(_body(content), vocab.AUTH_MARKERS), F.concat(F.lit("redirected_to_"), F.trim(fragment, F.lit("/"))), F.lit("")))
    )


def ok(status: Column, content: Column) -> Column:
    return (status == 200) & (F.coalesce(F.length(content), F.lit(0)) > 0)


def is_retryable(status: Column) -> Column:
    return status.isin(*vocab.RETRYABLE_STATUS)


def backoff_delay(attempt: Column, base: float, strategy: str = "exponential", jitter: Column | None = None) -> Column:
    """Seconds before a retry (attempts from 1), at most 60 before up to a quarter of jitter (0..1)."""
    delay = F.lit(base) if strategy == "fixed" else F.lit(base) * F.pow(F.lit(2.0), F.greatest(attempt - 1, F.lit(0)))
    delay = F.least(delay, F.lit(60.0))
    return delay if jitter is None else delay * (F.lit(1.0) + jitter * 0.25)


def retry_after_seconds(header: Column) -> Column:
    return F.least(F.lit(120.0), F.greatest(F.lit(0.0), F.coalesce(F.trim(header).try_cast("double"), F.lit(0.0))))


def robots_policy(status: Column, content: Column) -> Column:
    """struct(fetched, default_allow, note) of a robots.txt response."""
    page = sniff_kind(content).isin("html", "xml")
    full = (status == 200) & (F.coalesce(F.length(content), F.lit(0)) > 0)
    row = lambda fetched, allow, note: F.struct(F.lit(fetched).alias("fetched"), F.lit(allow).alias("default_allow"), F.lit(note).alias("note"))
    return (
        F.when(full & page, row(False, True, "robots.txt is a page; treated as absent"))
        .when(full, row(True, True, ""))
        .when(status.isin(404, 410), row(False, True, "no robots.txt found"))
        .when(status.isin(401, 403), row(False, False, "access to robots.txt refused"))
        .when(status == 0, row(False, False, "robots.txt unreachable"))
        .when((status >= 500) & (status < 600), row(False, False, "robots.txt server error"))
        .otherwise(row(False, True, "robots.txt treated as absent"))
    )


