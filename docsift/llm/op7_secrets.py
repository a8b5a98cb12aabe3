"""Operator 7: secret scans with rules and a character convolutional network.

Three rules find base spans.  Every other candidate, a run of token characters that
base spans leave over, is read with its surroundings by a small convolutional network
in numpy (character embedding by lookup, one convolution, max pooling, one output).

Training.  Labelled findings are rule spans (1, an assignment without its keyword) and
ordinary runs (0); the network learns from a bounded sample of them, whole findings in
overlapping windows.  Calibration and thresholds cover all data: one pass scores every
labelled finding of the corpus that is kept from training into histograms, summed
across tasks; a logistic fit of these calibrates, and the threshold is the highest at
which each kind of rule keeps the required recall.  The network adds spans and never
removes a rule's.

Base spans are code points, end exclusive, of the whole match.  Long candidates are
read in overlapping windows, and the best window counts.

Defined cases: null text counts as empty, without spans; with too few labelled
findings the network adds nothing; ties in the sample's order are broken by the windows
themselves; repeated rows are scanned each; a very long text is scanned whole; an empty
table gives no rows; extra columns are ignored, and redact keeps them.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm.common import discard, map_arrow, per_batch, stored, table

# The rules, each with the least length that counts.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_WORDS = ("pass", "secret", "token", "key")
KINDS = ("assign", "access", "hex", "net")

_RUN = re.compile(r"[A-Za-z0-9+/_=.-]{6,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]+")
#: The least length of a candidate; shorter ones that no rule finds are words, numbers and names.
LEAST = 12
SIDE, BODY, STEP = 24, 48, 24
_LENGTH = 2 * SIDE + BODY
_CLASSES = 2 * 130
#: The bounded training sample: documents read for findings, and findings' windows of each label.
TRAIN_DOCS, TRAIN_ROWS = 20_000, 1500
RECALL = 0.98
#: Of the findings, by hash, one in SHARES calibrates and never trains; the others may train.
SHARES = 3
#: Bins of the score histograms, over raw scores from -RANGE to RANGE.
BINS, RANGE = 2048, 32.0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the rules' matches, in order; kinds by their place in KINDS."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _left_over(start: int, end: int, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The parts of a span that base spans (in order) don't cover."""
    parts = []
    for s, _, e in base:
        if e <= start or s >= end:
            continue
        if s > start:
            parts.append((start, s))
        start = max(start, e)
    return [*parts, (start, end)] if start < end else parts


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What base spans leave of runs of token characters, where it is long enough and holds a digit and a letter."""
    found, at = [], 0
    for m in _CANDIDATE.finditer(text):
        if m.end() - m.start() < LEAST:
            continue
        while at < len(base) and base[at][2] <= m.start():
            at += 1
        for start, end in _left_over(m.start(), m.end(), base[at:]) if at < len(base) and base[at][0] < m.end() else [m.span()]:
            run = text[start:end]
            if len(run) >= LEAST and any(map(str.isdigit, run)) and any(map(str.isalpha, run)):
                found.append((start, end))
    return found


def windows(text: str, start: int, end: int) -> np.ndarray:
    """Character codes of a span with its surroundings; a long span has several overlapping rows."""
    rows = []
    for lo in range(start, max(start + 1, end - BODY + STEP), STEP):
        hi = min(lo + BODY, end)
        row = np.full(_LENGTH, 129, np.int16)
        for base, piece, inside in ((SIDE - len(text[max(0, lo - SIDE) : lo]), text[max(0, lo - SIDE) : lo], 0), (SIDE, text[lo:hi], 130), (SIDE + hi - lo, text[hi : hi + SIDE], 0)):
            if piece:
                row[base : base + len(piece)] = np.minimum(np.frombuffer(piece.encode("utf-32-le", "replace"), "<u4"), 128).astype(np.int16) + inside
        rows.append(row)
        if hi == end:
            break
    return np.stack(rows)


class Net:
    """Convolution over one-hot characters (as table lookups), max pooling, logistic output."""

    WIDTH, FILTERS = 5, 24

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.w = rng.normal(0, 0.1, (self.WIDTH, _CLASSES, self.FILTERS)).astype(np.float32)
        self.b = np.zeros(self.FILTERS, np.float32)
        self.v = rng.normal(0, 0.1, self.FILTERS).astype(np.float32)
        self.c = np.float32(0)
        self.scale, self.shift, self.least = 1.0, 0.0, np.inf

    def _pool(self, x):
        span = x.shape[1] - self.WIDTH + 1
        z = self.b + sum(self.w[k][x[:, k : k + span]] for k in range(self.WIDTH))
        at = z.argmax(axis=1)
        return np.maximum(np.take_along_axis(z, at[:, None], 1)[:, 0], 0), at

    def raw(self, x: np.ndarray) -> np.ndarray:
        parts = [self._pool(x[i : i + 512])[0] @ self.v + self.c for i in range(0, len(x), 512)]
        return np.concatenate(parts).astype(np.float64) if parts else np.empty(0)

    @property
    def threshold(self) -> float:
        """The least probability of a secret."""
        return float(self._sigmoid(self.least))

    def _sigmoid(self, z):
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -60, 60)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self._sigmoid(self.raw(x))

    def train(self, x: np.ndarray, y: np.ndarray, rounds: int = 30, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        rate = 0.5
        for _ in range(rounds):
            order = rng.permutation(len(x))
            for i in range(0, len(x), 64):
                part = order[i : i + 64]
                pooled, at = self._pool(x[part])
                p = 1 / (1 + np.exp(-np.clip(pooled @ self.v + self.c, -30, 30)))
                error = ((p - y[part]) / len(part)).astype(np.float32)
                back = np.where(pooled > 0, error[:, None] * self.v, 0).astype(np.float32)
                self.v -= rate * (pooled.T @ error + 1e-4 * self.v)
                self.c -= np.float32(rate * error.sum())
                self.b -= rate * back.sum(axis=0)
                f = np.broadcast_to(np.arange(self.FILTERS), at.shape)
                for k in range(self.WIDTH):
                    np.add.at(self.w[k], (np.take_along_axis(x[part], at + k, 1), f), -rate * back)
            rate *= 0.93

    def calibrate(self, counts: np.ndarray, recall: float) -> None:
        """From histograms of raw scores (row 0: negatives, others: kinds of positives), a logistic fit, and the highest threshold at which every kind keeps this recall."""
        z = (np.arange(BINS) + 0.5) * (2 * RANGE / BINS) - RANGE
        positive, all_of = counts[1:].sum(axis=0), counts.sum(axis=0)
        total, a, b = max(1.0, all_of.sum()), 1.0, 0.0
        size = max(1.0, float((all_of * z * z).sum() / total))
        for _ in range(500):
            error = all_of / (1 + np.exp(-np.clip(a * z + b, -60, 60))) - positive
            a -= 0.5 * float((error * z).sum() / total / size)
            b -= 0.5 * float(error.sum() / total)
        self.scale, self.shift = max(a, 1e-3), b
        edges = np.arange(BINS) * (2 * RANGE / BINS) - RANGE
        for kind in counts[1:]:
            if kind.sum():
                reached = np.cumsum(kind[::-1])[::-1] >= recall * kind.sum()
                self.least = min(self.least, float(edges[np.flatnonzero(reached)[-1]]))


def _labelled(text: str) -> list[tuple[int, int, int]]:
    """Findings (label, start, end) of a text: rule spans by kind from 1, an assignment without its keyword, and the ordinary runs (0)."""
    base = base_spans(text)
    found = [(kind + 1, _ASSIGN.match(text, start).start(2) if kind == 0 else start, end) for start, kind, end in base]
    at = 0
    for m in _RUN.finditer(text):
        while at < len(base) and base[at][2] <= m.start():
            at += 1
        if at == len(base) or base[at][0] >= m.end():
            found.append((0, *m.span()))
    return found


def _digest(text: str, start: int, end: int) -> int:
    """A hash of a finding with its surroundings; it says whether the finding trains."""
    return xxhash.xxh3_64_intdigest(text[max(0, start - SIDE) : end + SIDE].encode("utf-8", "replace"))


def _findings(batch):
    """Windows of a batch's findings that may train: rule spans, and of ordinary runs those two a text with the least hashes."""
    rows = []
    for text in batch.column(0).to_pylist():
        if not text:
            continue
        found = sorted((_digest(text, s, e), label, s, e) for label, s, e in _labelled(text))
        ordinary = [f for f in found if f[1] == 0 and f[0] % SHARES][:2]
        for h, label, s, e in [*(f for f in found if f[1] and f[0] % SHARES), *ordinary]:
            rows += [(min(label, 1), h - (1 << 63), w.astype("<i2").tobytes()) for w in windows(text, s, e)]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.binary()))], names=["label", "place", "x"])


def _histograms(net: Net):
    """Per task, counts of (label, bin) of the raw scores of all findings kept from training; a finding's best window counts."""

    def run(batches):
        counts = np.zeros((4, BINS), np.int64)
        for batch in batches:
            held, labels = [], []
            for text in batch.column(0).to_pylist():
                for label, s, e in _labelled(text) if text else ():
                    # all rule spans; of the far more numerous ordinary runs those that scan() would read
                    if (label or e - s >= LEAST) and _digest(text, s, e) % SHARES == 0:
                        held.append(windows(text, s, e))
                        labels.append(label)
                if len(held) >= 4096:
                    _count(net, held, labels, counts)
                    held, labels = [], []
            _count(net, held, labels, counts)
        label, place = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(label.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(counts[label, place])], names=["label", "bin", "n"])

    return run


def _count(net: Net, held: list[np.ndarray], labels: list[int], counts: np.ndarray) -> None:
    if held:
        raw = net.raw(np.concatenate(held).astype(np.int64))
        best = np.maximum.reduceat(raw, np.cumsum([0, *map(len, held[:-1])]))
        np.add.at(counts, (np.array(labels), np.clip(((best + RANGE) * (BINS / (2 * RANGE))).astype(np.int64), 0, BINS - 1)), 1)


def fit(docs: DataFrame, text_col: str = "text", train_docs: int = TRAIN_DOCS, train_rows: int = TRAIN_ROWS) -> Net | None:
    """Train on a bounded sample of labelled findings, calibrate and set the threshold on all findings kept from training; None where there are too few."""
    texts = docs.select(F.col(text_col).alias("text"))
    share = min(1.0, train_docs / max(1, docs.count()))
    some = texts.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(share * 1_000_000)) if share < 1 else texts
    found = stored(map_arrow(some, per_batch(_findings), "label int, place long, x binary").distinct(), "findings")
    got = [r for label in (1, 0) for r in found.where(F.col("label") == label).orderBy("place", "x").limit(train_rows).collect()]
    discard(found)
    y = np.array([r["label"] for r in got], np.float32)
    if len(got) < 40 or y.sum() < 20 or (1 - y).sum() < 20:
        return None
    net = Net()
    net.train(np.stack([np.frombuffer(bytes(r["x"]), "<i2") for r in got]).astype(np.int64), y)
    counts = np.zeros((4, BINS))
    for r in map_arrow(texts, _histograms(net), "label int, bin int, n long").groupBy("label", "bin").agg(F.sum("n").alias("n")).collect():  # 4 x BINS rows at most
        counts[r["label"], r["bin"]] = r["n"]
    net.calibrate(counts, RECALL)
    return net


def scan(texts: list[str | None], net: Net | None) -> list[list[tuple[int, int, int]]]:
    """All spans of each text, in order: the rules' and those the network adds."""
    spans, of, rows = [], [], []
    for i, text in enumerate(texts):
        base = base_spans(text) if text else []
        spans.append(base)
        if net is not None and text:
            for start, end in candidates(text, base):
                part = windows(text, start, end)
                rows.append(part)
                of += [(i, start, end)] * len(part)
    if rows:
        raw = net.raw(np.concatenate(rows).astype(np.int64))
        for i, start, end in sorted({o for o, z in zip(of, raw) if z >= net.least}):
            spans[i] = [*spans[i], (start, 3, end)]
    return [sorted(s) for s in spans]


def said(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_secrets(docs: DataFrame, net: Net | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document with its counts, the checksum of its base spans and all spans."""

    def run(batch):
        rows = []
        for spans in scan(batch.column(1).to_pylist(), net):
            n = [sum(k == kind for _, k, _ in spans) for kind in range(3)]
            base = said(s for s in spans if s[1] < 3)
            rows.append((*n, hashlib.sha256(base.encode()).hexdigest(), said(spans)))
        kinds = [pa.int64()] * 3 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(rows, per_batch(run), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, net: Net | None, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """docs with every span replaced by a mark; overlapping spans get one."""

    def run(batch):
        texts = batch.column(text_col).to_pylist()
        for i, spans in enumerate(scan(texts, net)):
            if not spans:
                continue
            out, at = [], 0
            for start, _, end in spans:
                if start >= at:
                    out += [texts[i][at:start], mark]
                at = max(at, end)
            texts[i] = "".join(out) + texts[i][at:]
        k = batch.schema.get_field_index(text_col)
        return batch.set_column(k, batch.schema.field(k), pa.array(texts, batch.schema.field(k).type))

    return map_arrow(docs, per_batch(run), docs.schema)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_secrets(docs, fit(docs))


QUERIES = {"op7_secrets": op7_secrets}
