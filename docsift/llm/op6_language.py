"""Operator 6: hierarchical language identification.

A linear support vector machine for each family of related languages (one against
the rest) predicts the family; within it, a machine for each pair of languages (one
versus one) votes.  Features are hashed byte trigrams of the lower-cased letters of
the whole text.  Machines are trained in numpy on a bounded sample of labelled rows:
at most `per_language` texts of each language (those with the least hashes of doc_id,
then of the text, so the sample is the same however rows arrive), each as a
fixed-length vector.  Every label is learned: where there are many, a
language's share of SAMPLE_ROWS shrinks, but not below LEAST texts, so what the driver
gathers grows with the number of languages alone.

Learning reads only rows whose crc32(doc_id as text) mod 5 is not 0.  A prediction
reads the text alone.  The score is the family's probability times the language's
share of the votes' probabilities, between 0 and 1.

Defined cases: `und` with score 0 where the text is null or has no letter, and for
every text when no labelled row can be learned from; a null doc_id counts as the
empty text in crc32 and is not learned from; null labels are not learned; repeated rows
are predicted each and learned once; a very long text is one vector; of equal votes or
families the first in order of code wins; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.llm.common import crc_mod, map_arrow, per_batch, table

DIM = 4096
#: The bounded sample: labelled texts of each language, texts in all, and the texts that a language's share never shrinks below.
PER_LANGUAGE, SAMPLE_ROWS, LEAST = 512, 8192, 16
UNKNOWN = "und"

# Language codes by family.
FAMILIES = {
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl"],
    "germanic": ["en", "de", "nl", "sv", "da", "no", "is"],
    "slavic": ["ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk"],
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}
#: Bytes that are not letters become a space.
_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def family_of(lang: str) -> str:
    """A code's family; an unknown code is a family of its own."""
    return _FAMILY_OF.get(lang.lower(), f"only {lang}")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """Unit vector of damped counts of hashed byte trigrams within and at the edges of words."""
    b = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(_LETTERS) + b" ", np.uint8)
    b = b[np.concatenate([[True], (b[1:] != 32) | (b[:-1] != 32)])].astype(np.uint32)
    if len(b) < 3:
        return np.zeros(DIM, np.float32)
    codes = ((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(20)
    counts = np.log1p(np.bincount(codes, minlength=DIM).astype(np.float32))
    norm = float(np.sqrt(counts @ counts))
    return counts / norm if norm else counts


def train_svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, rounds: int = 120) -> np.ndarray:
    """Linear machine with squared hinge loss (classes weighed alike), by accelerated gradient steps; y is +1 or -1, with a column for each machine if there are several. The last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    weigh = np.where(y > 0, 0.5 / np.maximum(1, (y > 0).sum(axis=0)), 0.5 / np.maximum(1, (y < 0).sum(axis=0))).astype(np.float32)
    w = v = np.zeros((x.shape[1], *y.shape[1:]), np.float32)
    ridge, step = np.float32(1e-3 / c), np.float32(0.2)
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ v))
        gradient = ridge * v - 2 * (x.T @ (weigh * slack * y))
        new = v - step * gradient
        v = new + (k / (k + 3)) * (new - w)
        w = new
    return w.astype(np.float32)


class Model:
    """Family machines, pair machines, and the languages of each family."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.members: dict[str, list[str]] = {}
        for lang in sorted(set(langs)):
            self.members.setdefault(family_of(lang), []).append(lang)
        self.families = sorted(self.members)
        own, family = np.array(langs), np.array([family_of(v) for v in langs])
        sign = lambda hit: np.where(hit, 1.0, -1.0).astype(np.float32)
        self.family_w = np.ascontiguousarray(train_svm(x, sign(family[:, None] == np.array(self.families))).T) if len(self.families) > 1 else None
        self.pair_w = {}
        for codes in self.members.values():
            for a, b in combinations(codes, 2):
                rows = (own == a) | (own == b)
                self.pair_w[a, b] = train_svm(x[rows], sign(own[rows] == a))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        x = np.hstack([x, np.ones((len(x), 1), np.float32)])
        if self.family_w is None:
            chosen, p = np.zeros(len(x), np.int64), np.ones(len(x))
        else:
            z = 4 * (x @ self.family_w.T).astype(np.float64)
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            chosen, p = z.argmax(axis=1), z.max(axis=1)
        langs, score = np.empty(len(x), object), p.copy()
        for k, f in enumerate(self.families):
            rows, codes = np.flatnonzero(chosen == k), self.members[f]
            votes = np.full((len(rows), len(codes)), 1.0 if len(codes) == 1 else 0.0)
            for i, j in combinations(range(len(codes)), 2):
                q = 1 / (1 + np.exp(-4 * (x[rows] @ self.pair_w[codes[i], codes[j]]).astype(np.float64)))
                votes[:, i] += q
                votes[:, j] += 1 - q
            best = votes.argmax(axis=1)
            for r, n in zip(rows, best):
                langs[r] = codes[n]
            score[rows] *= votes[np.arange(len(rows)), best] / max(1, len(codes) - 1)
        return langs.tolist(), np.clip(score, 0, 1)


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """Train on a bounded sample of the labelled rows whose checksum allows learning."""
    known = docs.where((crc_mod(F.col("doc_id"), 5) != 0) & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return None
    per_language = min(per_language, max(LEAST, SAMPLE_ROWS // len(counts)))
    # a slice of each language's hash range holds a few times what is wanted; so few rows meet when the least are picked
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    slices = [(v, int((1 << 30) * min(1.0, 4 * (per_language + 16) / n))) for v, n in counts.items()]
    slices = docs.sparkSession.createDataFrame(slices, "lang string, slice long")
    some = known.select("doc_id", "lang", place.alias("place"), F.xxhash64("text").alias("h")).join(F.broadcast(slices), "lang").where("slice > place").select("doc_id", "lang", "place", "h")
    least = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id", "h"))
    chosen = some.withColumn("n", least).where(F.col("n") <= per_language).select("doc_id", "lang", "h").distinct()

    def run(batch):
        rows = [(v, features(t).tobytes()) for t, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if has_letter(t)]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], names=["lang", "x"])

    # at most per_language keys of each language are broadcast; rows that repeat one are dropped before features are made
    rows = docs.select("doc_id", "lang", F.xxhash64("text").alias("h"), "text").join(F.broadcast(chosen), ["doc_id", "lang", "h"], "left_semi").dropDuplicates(["doc_id", "lang", "h"])
    got = sorted((r["lang"], bytes(r["x"])) for r in map_arrow(rows.select("text", "lang"), per_batch(run), "lang string, x binary").collect())
    return Model(np.stack([np.frombuffer(x, np.float32) for _, x in got]), [v for v, _ in got]) if got else None


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """All columns of docs, with a prediction and its score; columns that have these two names are replaced."""
    rows = docs.drop(lang_col, score_col)
    names = [*rows.columns, lang_col, score_col]
    schema = T.StructType([*rows.schema.fields, T.StructField(lang_col, T.StringType()), T.StructField(score_col, T.DoubleType())])

    def run(batch):
        texts = batch.column(text_col).to_pylist()
        at = [i for i, t in enumerate(texts) if has_letter(t)] if model else []
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        for lo in range(0, len(at), 1024):
            part = at[lo : lo + 1024]
            for i, lang, score in zip(part, *model.predict(np.stack([features(texts[i]) for i in part]))):
                langs[i], scores[i] = lang, float(score)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs), pa.array(scores)], names=names)

    return map_arrow(rows, per_batch(run), schema)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs.select("doc_id", "text"), fit(docs.select("doc_id", "text", "lang")))
    return found.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


QUERIES = {"op6_language": op6_language}
