"""Operator 1: benchmark decontamination with a distributed positional inverted index.

Documents are indexed in segments, as search engines do: a stored row holds some
documents, and for each term of theirs the list of its positions in the segment
(positions of different documents are too far apart for a match to cross).  Phrases
are looked up segment by segment: the terms' lists are taken from the rarest on,
shifted by each term's place in the phrase, and intersected.  Proximity matches
start from the rarest term as well.  A document lives in one segment, so results
need no shuffle, and a term or passage that very many documents share costs each
segment its own part only.

The test phrases are the stated query set.  They are sent along only where the object
built of them is proven to fit BROADCAST_BYTES; else tasks write them to the shared
folder in blocks, and every segment meets every block.  An index may be restricted to
the terms that will be asked for.

Terms are kept as 64-bit hashes; two words would have to share one, at each place of
a phrase where they differ, to give a false match.

Defined cases: null text has no words; an item without words has no phrase; a null
item id counts as the empty text; items that repeat an id count once; repeated rows
are all reported; a very long text makes a segment of its own; of equally rare terms the
first in the phrase is looked up first; empty tables give no rows, or clean documents;
extra columns are ignored, and drop_contaminated keeps them.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm import files
from docsift.llm.common import BROADCAST_BYTES, blocks, encoded, map_arrow, run_folder, stored, table

WINDOW = 10
#: Between documents of a segment; longer than any phrase and proximity span.
GAP = 64
SEGMENT_BYTES = 8 << 20
#: Bytes that what is built of a byte of test text takes at most, about: a window's hashes for every word.
BUILT = 24
#: Lower-cases A-Z and turns every byte that is no word character into a space.
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

INDEX = "doc_ids array<long>, n_words array<long>, terms binary, ends binary, positions binary"


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


def term_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


def _packed(numbers: np.ndarray) -> bytes:
    """Differences, byte plane by byte plane, so that the file's codec sees the zeros together."""
    return np.ascontiguousarray(np.diff(numbers, prepend=0).astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i4").ravel().astype(np.int64))


def _segment(doc_ids: list, texts: list[bytes], vocabulary: dict[bytes, int] | None) -> dict:
    lists = [words(t) for t in texts]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = [w for part in lists for w in part]
    if vocabulary is None:
        names = {w: k for k, w in enumerate(dict.fromkeys(flat))}
        hashes = np.fromiter(map(term_hash, names), np.int64, len(names))
    else:
        names = vocabulary
        hashes = np.fromiter(map(term_hash, names), np.int64, len(names))
    codes = np.fromiter(map(names.get, flat, repeat(-1)), np.int64, len(flat))
    bases = np.concatenate([[0], np.cumsum(counts + GAP)[:-1]]) if len(counts) else counts
    places = np.arange(len(flat)) + np.repeat(bases - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    kept = codes >= 0
    codes, places = codes[kept], places[kept]
    order = np.lexsort((places, hashes[codes])) if len(codes) else np.empty(0, np.int64)
    terms, sizes = np.unique(hashes[codes], return_counts=True)
    return {"doc_ids": doc_ids, "n_words": counts.tolist(), "terms": terms.astype("<i8").tobytes(), "ends": np.cumsum(sizes).astype("<i8").tobytes(), "positions": _packed(places[order])}


def build_index(docs: DataFrame, vocabulary: Iterable[bytes] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index: a row per segment. vocabulary: the only terms to keep lists of (None: all)."""
    names = None if vocabulary is None else {w: k for k, w in enumerate(sorted(vocabulary))}

    def run(batches):
        for batch in batches:
            texts, ids = encoded(batch.column(1)), batch.column(0).to_pylist()
            for lo, hi in blocks(texts, SEGMENT_BYTES):
                row = _segment(ids[lo:hi], texts[lo:hi], names)
                yield pa.RecordBatch.from_pydict({"doc_ids": pa.array([row["doc_ids"]], pa.list_(pa.int64())), "n_words": pa.array([row["n_words"]], pa.list_(pa.int64())), **{k: pa.array([row[k]], pa.binary()) for k in ("terms", "ends", "positions")}})

    return stored(map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, INDEX), "postings")


class Phrases:
    """Distinct windows of test items, by length: (hashes of their terms, bounds, item numbers); window i has the items owners[bounds[i]:bounds[i + 1]]."""

    def __init__(self, items: Iterable[tuple[str, bytes]], window: int = WINDOW):
        found: dict[tuple[bytes, ...], set[str]] = {}
        for name, text in items:
            own = words(text)
            for i in range(max(1, len(own) - window + 1) if own else 0):
                found.setdefault(tuple(own[i : i + window]), set()).add(name)
        self.names = sorted({n for s in found.values() for n in s})
        number = {n: k for k, n in enumerate(self.names)}
        self.terms = sorted({w for p in found for w in p})
        hash_of = {w: term_hash(w) for w in self.terms}
        self.by_length: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for length in sorted({len(p) for p in found}):
            own = [p for p in found if len(p) == length]
            owners = [sorted(number[n] for n in found[p]) for p in own]
            self.by_length.append((np.array([[hash_of[w] for w in p] for p in own], np.int64), np.cumsum([0, *map(len, owners)]), np.array([n for o in owners for n in o], np.int32)))

    def bytes(self) -> int:
        """About what sending this object along takes."""
        return sum(x.nbytes for part in self.by_length for x in part) + sum(len(n) + 16 for n in [*self.names, *self.terms])

    def owners(self, part: tuple[np.ndarray, ...], i: int) -> list[str]:
        return [self.names[n] for n in part[2][part[1][i] : part[1][i + 1]]]


class Segment:
    """An index row, opened for lookups."""

    def __init__(self, row: dict):
        self.doc_ids, self.n_words = row["doc_ids"], np.array(row["n_words"], np.int64)
        self.bases = np.concatenate([[0], np.cumsum(self.n_words + GAP)[:-1]])
        self.terms, self.ends = np.frombuffer(row["terms"], "<i8"), np.frombuffer(row["ends"], "<i8")
        self.starts = np.concatenate([[0], self.ends[:-1]]) if len(self.ends) else self.ends
        # lists follow one another, each from its own first position: differences run through
        self.places = _unpacked(row["positions"])
        self.size = int((self.n_words + GAP).sum())

    def postings(self, k: int) -> np.ndarray:
        return self.places[self.starts[k] : self.ends[k]]

    def _known(self, phrases: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of the phrases whose terms all occur here: number, terms' places in the index, and their order from the rarest on."""
        if not len(self.terms) or not len(phrases):
            return
        at = np.minimum(np.searchsorted(self.terms, phrases), len(self.terms) - 1)
        sizes = self.ends[at] - self.starts[at]
        for i in np.flatnonzero((self.terms[at] == phrases).all(axis=1)):
            yield int(i), at[i], np.argsort(sizes[i], kind="stable")

    def exact(self, phrases: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(phrase, start positions) by intersecting lists from the rarest term on."""
        for i, at, order in self._known(phrases):
            starts = self.postings(at[order[0]]) - order[0]
            for k in order[1:]:
                own = self.postings(at[k])
                j = np.searchsorted(own, starts + k)
                starts = starts[own[np.minimum(j, len(own) - 1)] == starts + k]
                if not len(starts):
                    break
            if len(starts):
                yield i, starts

    def near(self, phrases: np.ndarray, slop: int) -> Iterator[tuple[int, np.ndarray]]:
        """(phrase, positions of its rarest term) where every term occurs in one span of the phrase's length plus slop."""
        for i, at, order in self._known(phrases):
            span = len(at) + slop
            if span >= GAP:
                raise ValueError("the span must be shorter than the gap between documents")
            rare, lists = self.postings(at[order[0]]), [self.postings(k) for k in dict.fromkeys(at[order].tolist())]
            for own in lists[1:]:
                rare = rare[np.searchsorted(own, rare + span, "left") > np.searchsorted(own, rare - span, "right")]
                if not len(rare):
                    break
            hits = []
            for p in rare.tolist():
                for first in range(p - span + 1, p + 1):
                    if all(np.searchsorted(own, first + span, "left") > np.searchsorted(own, first, "left") for own in lists):
                        hits.append(p)
                        break
            if hits:
                yield i, np.array(hits)

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bases, positions, "right") - 1


def phrase_blocks(benchmark: DataFrame, window: int = WINDOW, limit: int = BROADCAST_BYTES, id_col: str = "item_id", text_col: str = "text") -> tuple[list, list[bytes] | None]:
    """The test phrases: one block to send along where what is built of them takes limit bytes at most, else URIs of blocks that tasks store; and the terms, where they are few enough to restrict an index to."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("item")), F.lit(0))).first()[0]
    if total * BUILT <= limit:  # few enough to be gathered; whether they may be sent is measured on what is built of them
        own = Phrases(((r["item"], r["text"].encode()) for r in rows.collect()), window)
        if own.bytes() <= limit:
            return [own], own.terms
    parts = max(2, -(-total * BUILT // limit))
    folder = run_folder(benchmark.sparkSession, "phrases")

    def run(batches):
        # a task's rows are those of one block or of several, which are told apart by the same hash
        held: dict[int, list] = {}
        for batch in batches:
            for part, item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), encoded(batch.column(2))):
                held.setdefault(part, []).append((item, text))
        for part, items in held.items():
            own, uri = Phrases(items, window), f"{folder}/{part}-{uuid.uuid4().hex}"
            own.terms = []
            with files.create(uri) as out:
                pickle.dump(own, out)
            yield pa.RecordBatch.from_pydict({"uri": [uri]})

    dealt = rows.distinct().select(F.pmod(F.xxhash64("item", "text"), F.lit(parts)).cast("int").alias("part"), "item", "text").repartition(parts, "part")
    return sorted(r["uri"] for r in stored(map_arrow(dealt, run, "uri string"), "phrase-blocks").collect()), None


def _opened(block) -> Phrases:
    return block if isinstance(block, Phrases) else pickle.loads(files.mapped(block, "u1").tobytes())


def _rows(batches) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k].as_py() for name in batch.schema.names}


def phrase_matches(index: DataFrame, phrases: list, slop: int | None = None) -> DataFrame:
    """A row per match: doc_id, item_id, kind (phrase or proximity), place (word number) and length."""

    def run(batches):
        for row in _rows(batches):
            segment, out = Segment(row), []
            for block in map(_opened, phrases):
                for part in block.by_length:
                    hashes = part[0]
                    kinds = [("phrase", segment.exact(hashes))] + ([] if slop is None else [("proximity", segment.near(hashes, slop))])
                    for kind, found in kinds:
                        for i, places in found:
                            for d, p in zip(segment.document(places), places):
                                out += [(segment.doc_ids[d], name, kind, int(p - segment.bases[d]), hashes.shape[1]) for name in block.owners(part, i)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["doc_id", "item_id", "kind", "place", "length"])

    return map_arrow(index, run, "doc_id long, item_id string, kind string, place long, length long")


def contamination(index: DataFrame, phrases: list) -> DataFrame:
    """A row per indexed document: its words, those inside an occurrence of a test phrase, and the items it has phrases of."""

    def run(batches):
        for row in _rows(batches):
            segment = Segment(row)
            edges = np.zeros(segment.size + 1, np.int64)
            owners: dict[int, set[str]] = {}
            for block in map(_opened, phrases):
                for part in block.by_length:
                    for i, starts in segment.exact(part[0]):
                        edges[starts] += 1
                        edges[starts + part[0].shape[1]] -= 1
                        names = block.owners(part, i)
                        for d in set(segment.document(starts).tolist()):
                            owners.setdefault(d, set()).update(names)
            covered = np.concatenate([[0], np.cumsum(np.cumsum(edges[:-1]) > 0)])
            hit = covered[segment.bases + segment.n_words] - covered[segment.bases]
            names = [sorted(owners.get(d, ())) for d in range(len(segment.doc_ids))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(segment.doc_ids, pa.int64()), pa.array(segment.n_words), pa.array(hit), pa.array([len(n) for n in names], pa.int64()), pa.array([hashlib.sha256(",".join(n).encode()).hexdigest() for n in names]), pa.array(hit > 0)],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return map_arrow(index, run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Index the documents for the benchmark's terms and report every document's contamination."""
    phrases, terms = phrase_blocks(benchmark, window)
    return contamination(build_index(docs, terms), phrases)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """docs without the rows that have a test phrase; each block of rows is indexed and looked up where it is read."""
    phrases, terms = phrase_blocks(benchmark, window)
    names = None if terms is None else {w: k for k, w in enumerate(sorted(terms))}

    def run(batches):
        for batch in batches:
            texts = encoded(batch.column(text_col))
            clean = np.ones(len(texts), bool)
            for lo, hi in blocks(texts, SEGMENT_BYTES):
                segment = Segment(_segment(list(range(lo, hi)), texts[lo:hi], names))
                for block in map(_opened, phrases):
                    for part in block.by_length:
                        for _, starts in segment.exact(part[0]):
                            clean[lo + segment.document(starts)] = False
            yield batch.filter(pa.array(clean))

    return map_arrow(docs, run, docs.schema)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
  b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
  win AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS p
        FROM b, LATERAL (SELECT unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i) WHERE len(w) > 0),
  spots AS (SELECT k, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
        FROM d, (SELECT DISTINCT n FROM win) AS lengths, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)),
  hit AS (SELECT spots.k, spots.n, spots.i, win.item FROM spots JOIN win ON spots.n = win.n AND spots.p = win.p),
  cover AS (SELECT k, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT k, n, i FROM hit), LATERAL (SELECT unnest(range(i, i + n)) AS j) GROUP BY k),
  own AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT k, item FROM hit) GROUP BY k)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (k) LEFT JOIN own USING (k)
"""

QUERIES = {"op1_decontamination": op1_decontamination}
ORACLES = {"op1_decontamination": _SQL}
