"""Links, titles and texts of pages by native patterns, and link extraction by a tolerant parser behind Arrow."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.functions import vocab
from docsift.functions.text import clean_text
from docsift.functions.urls import resolve
from docsift.session import ship

_DROPPED = ("script", "style", "noscript", "nav", "footer", "header")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"<[^>]+>", " ")


def unescape(c: Column) -> Column:
    """The common character references decoded; others stay as they are."""
    for name, char in vocab.REFERENCES:
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def _tag(name: str) -> str:
    """Pattern of an opening tag whose quoted values may hold anything."""
    return rf"""(?is)<{name}\b(?:[^>"']++|"[^"]*"|'[^']*')*>"""


def _attribute(tag: Column, name: str) -> Column:
    """Value of an opening tag's attribute, empty without."""
    value = F.regexp_extract(tag, rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return unescape(F.trim(F.regexp_replace(value, "^[\"']|[\"']$", "")))


def html_title(page: Column) -> Column:
    """struct(title, method): the first h1, the og:title (or title, dc.title) meta, both of 4 to 300 characters, else the title element without the site's name."""
    page = F.regexp_replace(page, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", " ")
    element = lambda tag: clean_text(unescape(strip_tags(F.regexp_extract(page, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1))))
    metas = F.regexp_extract_all(page, F.lit(_tag("meta")), F.lit(0))
    named = lambda name, value: F.get(F.filter(metas, lambda m: _attribute(m, name) == value), F.lit(0))
    meta = F.coalesce(named("property", "og:title"), named("name", "title"), named("name", "dc.title"), F.lit(""))
    own = clean_text(F.regexp_replace(element("title"), vocab.TITLE_BOILERPLATE, ""))
    found = F.filter(F.array(element("h1"), clean_text(_attribute(meta, "content"))), lambda t: F.length(t).between(4, 300))
    picked = F.transform(F.array(F.coalesce(F.get(found, F.lit(0)), own, F.lit(""))), lambda t: F.struct(t.alias("title"), F.when(t == "", F.lit("")).otherwise(F.lit("css_selector")).alias("method")))
    return F.get(picked, F.lit(0))


def html_text(page: Column, limit: int = 200_000) -> Column:
    """Readable text without scripts, styles and page furniture."""
    dropped = F.regexp_replace(page, rf"(?is)<({'|'.join(_DROPPED)})\b.*?</\1\s*>", " ")
    return F.substring(clean_text(strip_tags(dropped)), 1, limit)


def _instead(tag: Column, inner: Column) -> Column:
    """Text for an anchor without any: its own attributes in this order, then its first image's."""
    image = F.regexp_extract(inner, _tag("img"), 0)
    texts = F.array(*[_attribute(tag, a) for a in ("title", "aria-label", "data-title", "alt")], *[_attribute(image, a) for a in ("alt", "title")])
    return F.coalesce(F.get(F.filter(F.transform(texts, lambda t: clean_text(t)), lambda t: t != ""), F.lit(0)), F.lit(""))


def _framed(page: Column, tag: str, attribute: str) -> Column:
    return F.transform(F.regexp_extract_all(page, F.lit(_tag(tag)), F.lit(0)), lambda t: F.struct(_attribute(t, attribute).alias("h"), clean_text(_attribute(t, "title")).alias("text")))


def links(page: Column, base: Column) -> Column:
    """array of struct(seq, link, text): a page's http(s) links, the first of equal links only; no shuffle is needed.

    Anchors come in page order, then documents of iframe, embed and object; anchors in
    comments don't count.  An anchor without text takes that of its title, aria-label,
    data-title or alt, else of its image.
    """
    page = F.regexp_replace(page, r"(?s)<!--.*?-->", " ")
    whole = F.regexp_extract_all(page, F.lit(vocab.ANCHOR), F.lit(0))
    parts = F.transform(whole, lambda a: F.struct(a.alias("a"), F.regexp_extract(a, vocab.ANCHOR, 1).alias("h"), F.regexp_extract(a, vocab.ANCHOR, 2).alias("t")))
    href = lambda a: unescape(F.regexp_replace(F.regexp_replace(F.trim(a["h"]), "^[\"']+|[\"']+$", ""), r"^\s+|\s+$", ""))
    named = F.transform(parts, lambda a: F.struct(a["a"].alias("a"), href(a).alias("h"), a["t"].alias("t"), clean_text(unescape(strip_tags(a["t"]))).alias("text")))
    anchors = F.transform(named, lambda a: F.struct(a["h"].alias("h"), F.when(a["text"] != "", a["text"]).otherwise(_instead(F.regexp_extract(a["a"], _tag("a"), 0), a["t"])).alias("text")))
    found = F.concat(anchors, _framed(page, "iframe", "src"), _framed(page, "embed", "src"), _framed(page, "object", "data"))
    resolved = F.transform(found, lambda a, i: F.struct(i.alias("seq"), resolve(base, a["h"]).alias("link"), a["text"].alias("text")))
    kept = F.filter(resolved, lambda a: a["link"].isNotNull())
    names = lambda x: F.transform(x, lambda a: a["link"])
    first = F.transform(F.array(kept), lambda x: F.filter(x, lambda a, i: F.array_position(names(x), a["link"]) == i + 1))
    return F.get(first, F.lit(0))


def extract_links(pages: DataFrame, html: str = "html", base: str = "url", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (keep..., seq, link, text) of links(): seq counts from 0 by page and has gaps where links were dropped."""
    rows = pages.select(*keep, F.explode(links(F.col(html), F.col(base))).alias("_a"))
    return rows.select(*keep, F.col("_a.seq").alias("seq"), F.col("_a.link").alias("link"), F.col("_a.text").alias("text"))


class _Anchors(HTMLParser):
    """Anchors (with their text, or title and image texts) and framed documents, in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.pairs: list[list[str]] = []
        self.open: tuple[int, str] | None = None

    def handle_starttag(self, tag, attrs):
        own = {k: v or "" for k, v in attrs}
        if tag == "a" and own.get("href"):
            self.pairs.append([own["href"].strip(), ""])
            self.open = (len(self.pairs) - 1, next((own[k] for k in ("title", "aria-label", "data-title", "alt") if own.get(k)), ""))
        elif tag == "img" and self.open and not self.open[1]:
            self.open = (self.open[0], own.get("alt") or own.get("title") or "")
        elif tag in ("iframe", "embed", "object"):
            target = own.get("data" if tag == "object" else "src", "").strip()
            if target:
                self.pairs.append([target, own.get("title", "")])

    def handle_data(self, data):
        if self.open:
            self.pairs[self.open[0]][1] += data

    def handle_endtag(self, tag):
        if tag == "a" and self.open:
            at, instead = self.open
            if not self.pairs[at][1].strip():
                self.pairs[at][1] = instead
            self.open = None


def parsed_links(pages: DataFrame, html: str = "html", base: str = "url") -> DataFrame:
    """Rows (url, seq, href, text) by the tolerant parser; hrefs are not resolved."""
    ship(pages.sparkSession)

    def run(batches):
        for batch in batches:
            rows = []
            for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parser = _Anchors()
                parser.feed(page or "")
                parser.close()
                rows += [(url, k, h, " ".join(t.split())) for k, (h, t) in enumerate(parser.pairs)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int32(), pa.string(), pa.string()))], names=["url", "seq", "href", "text"])

    return pages.select(F.col(base).alias("url"), F.col(html).alias("html")).mapInArrow(run, "url string, seq int, href string, text string")
