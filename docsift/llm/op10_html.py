"""Operator 10: main-text extraction with consensus paths of hosts.

Each page's containers are scored by how much of the page's running text they hold
(links and boilerplate excluded), by how deep they are and by their names.  An
element's path, the tags around it with their classes and without numbers, stands for
a place of the page template.  The pages of a host vote, in Spark with partial sums,
so a host that holds a third of all pages is no burden:

* for container paths with their scores; every page is extracted again with its host's
  winning path, and a page without that path uses its own best container;
* on paths that are no article text: where different pages of a host have the same text
  at a path, or little but links, the host's consensus leaves that path out.

Names and roles that say what an element is (advert, comments, menu, ...) count on every
element, whatever its tag; header and footer only where they aren't an article's own.

What is agreed (a row per host) is sent to the executors only where it is proven small;
beyond that it is joined by host.

Text: character references are decoded, white space inside a block is one space,
blocks are joined in page order by one space; nothing is capped.

Defined cases: null or empty html has empty text; pages without a container use the
whole body; a null url votes under the empty host; of paths with equal scores the first
in order wins; repeated rows are extracted each (and vote each, but count as one page
where texts are compared); very long pages are parsed whole; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as references
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm.common import map_arrow, per_batch, stored, table

#: Characters of agreed paths that may be sent along; more are joined. Longer paths are written as a hash of theirs.
SENT_CHARS, PATH_CHARS = 16 << 20, 200
#: Different pages of a host (by a sketch, which is exact for so few) that a consensus against a path needs at least, and the share of links.
AGREED, LINKS = 5, 0.6

# Elements by role.
RAW = "script|style|noscript|template|textarea|iframe|svg|title|select|object|canvas"
BOILERPLATE = frozenset("nav footer aside form menu dialog button head".split())
CONTAINERS = frozenset("html body main article section div td center".split())
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NAMES = frozenset("ad ads adbox advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted promotion recommended related replies reply respond share sharing sidebar social sponsor sponsored subscribe subscription toolbar widget".split())
OUTER_NAMES = frozenset("footer header masthead".split())
CONTENT_NAMES = frozenset("article body content entry main page post story text".split())
#: A tag that ends the open one of these, up to the nearest of the others.
IMPLIED = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu".split())
_GOOD = re.compile(r"article|content|entry|post|story|main|body|text", re.I)

_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<({RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([A-Za-z][\w:-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NUMBERS, _PARTS = re.compile(r"\d+"), re.compile(r"[a-z]+")
_MASK = (1 << 64) - 1


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): references.unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(text)} if text.strip() else {}


class _Element:
    __slots__ = ("tag", "path", "dropped", "depth", "good", "link", "number", "hash")

    def __init__(self, tag, path, dropped, depth, number):
        self.tag, self.path, self.dropped, self.depth, self.number = tag, path, dropped, depth, number
        self.good = self.link = self.hash = 0


def _named_boilerplate(own: dict[str, str], inside: bool) -> bool:
    """Whether classes, id, role or state say that an element is no article text; inside: of an article."""
    if own.get("role", "").lower() in ROLES or "hidden" in own or own.get("aria-hidden") == "true":
        return True
    for name in f"{own.get('class', '')} {own.get('id', '')}".lower().split():
        parts = set(_PARTS.findall(name))
        if parts & NAMES or parts & OUTER_NAMES and not inside and not parts & CONTENT_NAMES:
            return True
    return False


def _path(parent: str, label: str) -> str:
    path = f"{parent}/{label}"
    return path if len(path) <= PATH_CHARS else "#" + hashlib.blake2b(path.encode("utf-8", "replace"), digest_size=12).hexdigest()


def parse(page: str) -> tuple[list[_Element], list[tuple[tuple[int, ...], str]]]:
    """Elements in page order, and blocks: the elements around each (outermost first) and its text. Named boilerplate is left out."""
    root = _Element("", "", False, 0, 0)
    elements, stack, blocks = [root], [root], []
    held: list[str] = []
    muted: list[str] = []
    linked, in_link = 0, False

    def close_block():
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text and not stack[-1].dropped:
                blocks.append((tuple(e.number for e in stack), text))
                own = xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"))
                for e in stack:
                    e.good += len(text)
                    e.link += linked
                    e.hash = (e.hash * 1_000_003 + own) & _MASK
        linked = 0
        muted.clear()

    def add(text):
        nonlocal linked
        if text and not muted and not stack[-1].dropped:
            text = references.unescape(text)
            held.append(text)
            if in_link:
                linked += len(text.strip())

    def implied(tag):
        """Ends elements that this tag's start ends without their end tags."""
        if stack[-1].tag == "p":
            stack.pop()
        ends, bound = IMPLIED.get(tag, ("", ""))
        if ends:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in bound.split():
                    break
                if stack[k].tag in ends.split():
                    del stack[k:]
                    break

    at = 0
    for m in _TOKEN.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        if m[3] is None:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:-3])
            continue
        tag, closing = m[3].lower(), bool(m[2])
        if tag == "a":
            in_link = not closing
        if tag not in BLOCKS:
            if muted:
                if closing and tag in muted:
                    del muted[len(muted) - 1 - muted[::-1].index(tag) :]
                elif not closing and tag not in VOID:
                    muted.append(tag)
            elif not closing and tag not in VOID and "=" in m[4] and _named_boilerplate(_attributes(m[4]), True):
                muted.append(tag)
            continue
        close_block()
        if tag in VOID:
            continue
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        implied(tag)
        own = _attributes(m[4])
        inside = any(e.tag in ("article", "main") for e in stack)
        dropped = stack[-1].dropped or tag in BOILERPLATE or tag == "header" and not inside
        dropped = dropped or tag not in ("html", "body", "main") and bool(own) and _named_boilerplate(own, inside)
        label = tag + "".join("." + _NUMBERS.sub("", c) for c in sorted(own.get("class", "").lower().split()))
        element = _Element(tag, _path(stack[-1].path, label), dropped, len(stack), len(elements))
        elements.append(element)
        stack.append(element)
    add(page[at:])
    close_block()
    return elements, blocks


def scored(elements: list[_Element]) -> list[tuple[float, str]]:
    """(score, path) of the containers that hold running text, best first; a path counts once with its best score."""
    whole = max(1, elements[0].good - elements[0].link)
    best: dict[str, float] = {}
    for e in elements[1:]:
        if e.dropped or not e.good or e.tag not in CONTAINERS:
            continue
        share = max(0, e.good - e.link) / whole
        score = share * (1 + 0.05 * min(e.depth, 8) + 0.5 * (e.tag in ("article", "main")) + 0.25 * bool(_GOOD.search(e.path.rsplit("/", 1)[-1]))) * (1 if share >= 0.5 else share)
        best[e.path] = max(best.get(e.path, 0), score)
    return sorted(((s, p) for p, s in best.items()), key=lambda x: (-x[0], x[1]))


def extract(page: str | None, path: str | None, left_out: frozenset[str] = frozenset()) -> str:
    """The text of the containers with this path, else of the page's best container, else of all that is not boilerplate; without elements at the paths left out."""
    if not page:
        return ""
    elements, blocks = parse(page)
    wanted = {e.number for e in elements if e.path == path and path and not e.dropped and e.good}
    if not wanted:
        own = scored(elements)
        wanted = {e.number for e in elements if own and e.path == own[0][1] and not e.dropped} or {0}
    around_wanted = {n for around, _ in blocks for k, n in enumerate(around) if not wanted.isdisjoint(around[k:])}
    out = {e.number for e in elements if e.path in left_out and e.number not in around_wanted}
    inner = [text for around, text in blocks if not wanted.isdisjoint(around) and out.isdisjoint(around)]
    return " ".join(inner)


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def votes(pages: DataFrame) -> DataFrame:
    """Rows (host, path, score, text, page, share): a page's vote on each of its paths; text and page are hashes of the text at the path and of the page's, share the part of links. pages has host and html."""

    def run(batches):
        for batch in batches:
            out = []
            for h, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not page:
                    continue
                elements, _ = parse(page)
                scores = {p: s for s, p in scored(elements)}
                of_path: dict[str, list[int]] = {}
                for e in elements[1:]:
                    if e.good and not e.dropped:
                        own = of_path.setdefault(e.path, [0, 0, 0])
                        own[0], own[1], own[2] = (own[0] * 1_000_003 + e.hash) & _MASK, own[1] + e.good, own[2] + e.link
                whole = elements[0].hash - (1 << 63)
                out += [(h, p, scores.get(p, 0.0), x - (1 << 63), whole, link / good) for p, (x, good, link) in of_path.items()]
            kinds = (pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], names=["host", "path", "score", "text", "page", "share"])

    return map_arrow(pages.select("host", "html"), run, "host string, path string, score double, text long, page long, share double")


def agreed(pages: DataFrame) -> DataFrame:
    """Rows (host, path, left_out): each host's path with the highest sum of scores (of equal sums the first in order), and the paths its pages leave out."""
    sums = votes(pages).groupBy("host", "path").agg(
        F.round(F.sum("score"), 6).alias("score"), F.approx_count_distinct("page").alias("n"), F.avg("share").alias("share"), (F.min("text") == F.max("text")).alias("same")
    )
    against = (F.col("n") >= AGREED) & (F.col("same") | (F.col("share") >= LINKS))
    best = F.min(F.when(F.col("score") > 0, F.struct((-F.col("score")).alias("s"), "path")))
    of_host = sums.groupBy("host").agg(best.alias("best"), F.collect_list(F.when(against, F.col("path"))).alias("left_out"))
    return of_host.select("host", F.col("best.path").alias("path"), "left_out")


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sent_chars: int = SENT_CHARS) -> DataFrame:
    """A row per page: page_id, url, text, n_chars."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    chosen = stored(agreed(rows), "host-paths")
    schema = "page_id long, url string, text string, n_chars long"

    def output(batch, found):
        texts = [extract(page, path, frozenset(left_out or ())) for page, (path, left_out) in zip(batch.column("html").to_pylist(), found)]
        return pa.RecordBatch.from_arrays([batch.column("page_id").cast(pa.int64()), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    size = F.length("host") + F.coalesce(F.length("path"), F.lit(0)) + F.length(F.array_join("left_out", " ")) + 100
    if (chosen.agg(F.sum(size)).first()[0] or 0) <= sent_chars:  # measured: small enough to be sent along
        known = {r["host"]: (r["path"], r["left_out"]) for r in chosen.collect()}
        return map_arrow(rows, per_batch(lambda batch: output(batch, (known.get(h, (None, ())) for h in batch.column("host").to_pylist()))), schema)
    joined = rows.join(chosen, "host", "left")
    return map_arrow(joined, per_batch(lambda batch: output(batch, zip(batch.column("path").to_pylist(), batch.column("left_out").to_pylist()))), schema)


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


QUERIES = {"op10_html": op10_html}
