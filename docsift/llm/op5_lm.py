"""Operator 5: a hidden Markov language model with exact likelihoods.

Counts.  Texts are stored in segments (a row: some documents as local word numbers,
and the segment's distinct words with their training counts).  Word counts are summed
over all segments and joined back to each segment's words, so a word crosses the
shuffle once a segment, not once an occurrence, and no vocabulary has to fit in one
place.

Model.  States emit word classes: the most frequent words are classes of their own,
all others fall into a fixed number of classes by the hash of their last three bytes.
Within its class a word has the probability (c + 1) / (N_class + V_class + 1).  The
model's size is so fixed, whatever the vocabulary.  Baum-Welch: a bounded sample
(whole documents of at most SAMPLE_TOKENS // 10 tokens) gives a first model on the
driver; after that every round is one pass over all whole training documents, whose
expected counts are summed within each task and then across tasks, until the
likelihood of the corpus settles.  Forward values are kept at every STRIDE-th token
and computed again between them, so memory doesn't grow with a document's length.

Score.  The scaled forward recursion over the whole uncut document, plus the words'
probabilities within their classes: the exact probability of the text in the model.

Held-out documents have crc32(doc_id as text) mod 7 = 2; the others train.

Defined cases: null text counts as empty, a sequence of the end token alone; a null
doc_id counts as the empty text in crc32; repeated rows count each; with no training
documents c = N = V = 0 and the model is uniform; a very long text is one sequence; of
equally frequent words the first in byte order is a class of its own; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm.common import LOWER, blocks, crc_mod, discard, encoded, map_arrow, per_batch, release, stored, table

STATES, TOP, TAILS = 8, 4000, 1024
CLASSES = TOP + TAILS
#: Forward values are kept so many tokens apart; tokens that are worked on in step at about.
STRIDE, TOKENS_AT_ONCE = 512, 400_000
#: Rounds over the bounded sample on the driver, its documents and tokens.
FIRST_ROUNDS, SAMPLE_DOCS, SAMPLE_TOKENS = 15, 1500, 300_000
#: Rounds over all documents go on while a token's mean log likelihood (natural) grows by more than SETTLED, ROUNDS at most.
ROUNDS, SETTLED = 4, 0.002
SEGMENT_BYTES, SEGMENT_WORDS, BLOCK = 16 << 20, 400_000, 2 << 20
END = b""


def tokens(text: bytes) -> list[bytes]:
    return [*text.translate(LOWER).split(), END]


def _planes(numbers: np.ndarray, width: int) -> bytes:
    """Byte plane by byte plane, so that a codec sees the high bytes together."""
    return np.ascontiguousarray(numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()


def _unplaned(data: bytes, width: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(f"<u{width}").ravel()


SEGMENTS = "seg long, documents binary, words array<binary>, counts array<long>"


def _segments(batches):
    """Documents of a partition gathered into segments; a document is never cut."""
    number = TaskContext.get().partitionId() << 32
    names: dict[bytes, int] = {}
    ids, held, lengths, codes, size = [], [], [], [], 0

    def row():
        flat = np.concatenate(codes)
        trains = np.repeat(~np.array(held), lengths)
        counts = np.bincount(flat[trains], minlength=len(names))
        documents = pickle.dumps((ids, held, np.array(lengths, np.int64), _planes(flat, 4)))
        values = {"seg": number, "documents": documents, "words": list(names), "counts": counts}
        kinds = (pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values.values(), kinds)], names=list(values))

    for batch in batches:
        texts, batch_ids, batch_held = encoded(batch.column(1)), batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for lo, hi in blocks(texts, BLOCK):
            lists = [tokens(t) for t in texts[lo:hi]]
            flat = [w for part in lists for w in part]
            for w in set(flat).difference(names):
                names[w] = len(names)
            codes.append(np.fromiter(map(names.__getitem__, flat), np.int32, len(flat)))
            ids += batch_ids[lo:hi]
            held += batch_held[lo:hi]
            lengths += map(len, lists)
            size += sum(map(len, texts[lo:hi]))
            if size >= SEGMENT_BYTES or len(names) >= SEGMENT_WORDS:
                yield row()
                number += 1
                names, ids, held, lengths, codes, size = {}, [], [], [], [], 0
    if ids:
        yield row()


class Lexicon:
    """Class totals of the training words: N, V, and the classes' own counts; bounded by the number of classes."""

    def __init__(self, top: list[bytes], n: np.ndarray, v: np.ndarray):
        self.top, self.class_n, self.class_v = top, n, v
        self.n, self.v = float(n.sum()), float(v.sum())


def _class_of(top: DataFrame, words: DataFrame) -> DataFrame:
    """words with class: the top word's own place, else a tail class by its last bytes."""
    tail = F.lit(TOP) + F.pmod(F.xxhash64(F.expr("substring(word, -3, 3)")), F.lit(TAILS))
    return words.join(F.broadcast(top), "word", "left").withColumn("class", F.coalesce(F.col("place"), tail.cast("int"))).drop("place")  # top has TOP rows at most


def count_words(segments: DataFrame) -> tuple[DataFrame, DataFrame, Lexicon]:
    """Training counts of all words (stored), the most frequent words with their places, and class totals."""
    pairs = segments.select(F.explode(F.arrays_zip("words", "counts")).alias("p")).select(F.col("p.words").alias("word"), F.col("p.counts").alias("n"))
    counts = stored(pairs.where("n > 0").groupBy("word").agg(F.sum("n").alias("c")), "word-counts")
    spark = segments.sparkSession
    best = counts.orderBy(F.desc("c"), "word").limit(TOP).collect()
    top = spark.createDataFrame([(bytearray(r["word"]), k) for k, r in enumerate(best)], "word binary, place int")
    totals = _class_of(top, counts).groupBy("class").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    n, v = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in totals:
        n[r["class"]], v[r["class"]] = r["n"], r["v"]
    return counts, top, Lexicon([bytes(r["word"]) for r in best], n, v)


SEQUENCES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, within double, classes binary"


def sequences(segments: DataFrame, counts: DataFrame, top: DataFrame, lexicon: Lexicon) -> DataFrame:
    """A row per document: base score, log10 probabilities within classes, and its classes in order.

    Each segment meets the counts of its words in one partition, in order: first the
    counts, row by row, then its documents; nothing is collected into long arrays.
    """
    words = segments.select("seg", F.posexplode("words").alias("at", "word")).join(counts, "word", "left")
    nothing = F.lit(None).cast("binary").alias("documents")
    known = _class_of(top, words).select("seg", F.lit(0).alias("kind"), "at", F.coalesce("c", F.lit(0)).cast("long").alias("c"), "class", nothing)
    held = segments.select("seg", F.lit(1).alias("kind"), F.lit(0).alias("at"), F.lit(0).cast("long").alias("c"), F.lit(0).alias("class"), "documents")
    # a few segments a task, however many there are
    shards = max(int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions")), segments.count() // 4, 1)
    rows = known.unionByName(held).repartition(shards, "seg").sortWithinPartitions("seg", "kind")
    class_n, class_v, n, v = lexicon.class_n, lexicon.class_v, lexicon.n, lexicon.v

    def coded(documents: bytes, words: list[tuple[np.ndarray, ...]]):
        ids, held, lengths, codes = pickle.loads(documents)
        at, c_of, kind_of = (np.concatenate(x) for x in zip(*words))
        codes, c, kind = _unplaned(codes, 4), np.empty(len(at)), np.empty(len(at), np.int64)
        c[at], kind[at] = c_of, kind_of
        base = np.log10((c + 1) / (n + v + 1))
        within = np.where(kind < TOP, 0.0, np.log10((c + 1) / (class_n[kind] + class_v[kind] + 1)))
        ends = np.cumsum(lengths)
        for lo in range(0, len(lengths), 2000):
            hi = min(lo + 2000, len(lengths))
            first = int(ends[lo] - lengths[lo])
            part = codes[first : int(ends[hi - 1])]
            starts = ends[lo:hi] - lengths[lo:hi] - first
            own = kind[part].astype("<u2")
            columns = [
                pa.array(ids[lo:hi], pa.int64()),
                pa.array(held[lo:hi], pa.bool_()),
                pa.array(lengths[lo:hi]),
                pa.array(np.add.reduceat((c[part] > 0).astype(np.int64), starts)),
                pa.array(np.add.reduceat(base[part], starts)),
                pa.array(np.add.reduceat(within[part], starts)),
                pa.array([_planes(own[s : s + m], 2) for s, m in zip(starts, lengths[lo:hi])], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "within", "classes"])

    def run(batches):
        words = []
        for batch in batches:
            start = 0
            columns = [batch.column(name).to_numpy() for name in ("at", "c", "class")]
            for k in np.flatnonzero(batch.column("kind").to_numpy() == 1).tolist():
                words.append(tuple(x[start:k].copy() for x in columns))
                yield from coded(batch.column("documents")[k].as_py(), words)
                words, start = [], k + 1
            words.append(tuple(x[start:].copy() for x in columns))

    return map_arrow(rows, run, SEQUENCES)


class Hmm:
    """Initial, transition and emission probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def first(cls, weights: np.ndarray, seed: int = 5) -> Hmm:
        """A perturbed unigram model that prefers to stay in its state."""
        rng = np.random.default_rng(seed)
        emit = (weights + 0.01) * rng.gamma(1.0, 1.0, (CLASSES, STATES))
        move = np.full((STATES, STATES), 0.2 / STATES) + 0.8 * np.eye(STATES)
        return cls(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))

    @classmethod
    def from_counts(cls, start, move, emit) -> Hmm:
        """Maximum likelihood with a little of each class in each state."""
        emit = emit + 0.01 + 0.001 * emit.sum(axis=1, keepdims=True) / STATES
        move, start = move + 0.1, start + 0.1
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))

    def expected(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts (start, move, emit) over whole class sequences, all in step, and their log likelihood with the number of tokens."""
        docs = sorted(docs, key=len, reverse=True)
        lengths = np.array([len(d) for d in docs])
        flat, starts = np.concatenate(docs), np.cumsum(lengths) - lengths
        longest = int(lengths[0])
        active = np.searchsorted(-lengths, -np.arange(longest), "left")
        emit, move, first = self.emit.astype(np.float32), self.move.astype(np.float32), self.start.astype(np.float32)
        ones = np.ones((STATES, 1), np.float32)  # sums over states as products, which are faster
        moves, gammas, emits = np.zeros((STATES, STATES)), None, np.zeros((CLASSES, STATES))
        # all forward values are kept where they are few; else every STRIDE-th, and those between are computed again
        stride = longest if len(flat) <= 2 * TOKENS_AT_ONCE else STRIDE
        kept, total = [], 0.0

        def forward(lo, hi, alpha, likelihood=False):
            """Scaled forward values of tokens lo..hi - 1 after alpha, what each token emits, and the tokens."""
            nonlocal total
            alphas, seen, symbols = [], [], []
            for t in range(lo, hi):
                n = active[t]
                symbols.append(flat[starts[:n] + t])
                seen.append(emit[symbols[-1]])
                alpha = (alpha[:n] @ move if t else np.broadcast_to(first, (n, STATES))) * seen[-1]
                scale = alpha @ ones
                alpha = alpha / scale
                if likelihood:
                    total += float(np.log(scale).sum())
                alphas.append(alpha)
            return alphas, seen, symbols

        alpha = None
        for lo in range(0, longest, stride):
            kept.append(alpha)
            found = forward(lo, min(lo + stride, longest), alpha, True)
            alpha = found[0][-1]
        beta = np.ones((active[-1], STATES), np.float32)
        for k in range(len(kept) - 1, -1, -1):
            lo, hi = k * stride, min((k + 1) * stride, longest)
            alphas, seen, symbols = found if k == len(kept) - 1 else forward(lo, hi, kept[k])
            gamma = [None] * (hi - lo)
            for t in range(hi - 1, lo - 1, -1):
                own = alphas[t - lo]
                if len(beta) < len(own):
                    beta = np.concatenate([beta, np.ones((len(own) - len(beta), STATES), np.float32)])
                g = own * beta
                gamma[t - lo] = g = g / (g @ ones)
                if t:
                    before = (alphas[t - lo - 1] if t > lo else kept[k])[: len(own)]
                    after = seen[t - lo] * beta
                    back = after @ move.T
                    moves += (before / ((before * back) @ ones)).T @ after
                    beta = back / (back @ ones)
            gammas = gamma[0]
            symbols, gamma = np.concatenate(symbols), np.concatenate(gamma)
            emits += np.stack([np.bincount(symbols, weights=gamma[:, s], minlength=CLASSES) for s in range(STATES)], axis=1)
        return gammas.sum(axis=0, dtype=np.float64), moves * self.move, emits, np.array([total, len(flat)])

    def log10(self, docs: list[np.ndarray]) -> np.ndarray:
        """Exact log10 probabilities of whole class sequences by the scaled forward recursion, all in step."""
        order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
        lengths = np.array([len(docs[i]) for i in order])
        flat = np.concatenate([docs[i] for i in order])
        starts = np.cumsum(lengths) - lengths
        total = np.zeros(len(docs))
        alpha = np.tile(self.start, (len(docs), 1))
        n = len(docs)
        for t in range(int(lengths[0])):
            while lengths[n - 1] <= t:
                n -= 1
            alpha = (alpha[:n] @ self.move if t else alpha) * self.emit[flat[starts[:n] + t]]
            if t % 8 == 7 or t + 1 >= lengths[n - 1]:
                scale = alpha.sum(axis=1)
                total[:n] += np.log10(scale)
                alpha = alpha / scale[:, None]
        out = np.empty(len(docs))
        out[order] = total
        return out


def _grouped(docs: list[np.ndarray], tokens: int = TOKENS_AT_ONCE) -> Iterator[list[np.ndarray]]:
    """Documents of like length together, about so many tokens at once."""
    docs = sorted(docs, key=len, reverse=True)
    ends = np.cumsum([len(d) for d in docs])
    lo = 0
    while lo < len(docs):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + tokens, "right")))
        yield docs[lo:hi]
        lo = hi


def _round(rows: DataFrame, model: Hmm) -> tuple[Hmm, float] | None:
    """One Baum-Welch round over all training rows, and a token's mean log likelihood before it; each task sums its own counts, Spark sums the tasks'."""

    def run(batches):
        total = None
        for batch in batches:
            for docs in _grouped([_unplaned(d, 2) for d in batch.column(0).to_pylist()]):
                got = model.expected(docs)
                total = got if total is None else [a + b for a, b in zip(total, got)]
        if total is not None:
            flat = np.concatenate([x.ravel() for x in total])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["at", "x"])

    sums = map_arrow(rows.where("not held_out").select("classes"), run, "at int, x double").groupBy("at").agg(F.sum("x").alias("x"))
    got = sums.collect()  # as many rows as the model has parameters
    if not got:
        return None
    flat = np.zeros(STATES + STATES * STATES + CLASSES * STATES + 2)
    for r in got:
        flat[r["at"]] = r["x"]
    start, move, emit, likelihood = np.split(flat, np.cumsum([STATES, STATES * STATES, CLASSES * STATES]))
    return Hmm.from_counts(start, move.reshape(STATES, STATES), emit.reshape(CLASSES, STATES)), float(likelihood[0] / likelihood[1])


def train(rows: DataFrame, lexicon: Lexicon) -> Hmm:
    """Baum-Welch: a first model from a bounded sample of whole documents, then rounds over all training documents until their likelihood settles."""
    model = Hmm.first((lexicon.class_n + 1)[:, None] / (lexicon.n + CLASSES))
    place = F.xxhash64("doc_id", "n_tokens", "base_score")
    short = rows.where((~F.col("held_out")) & (F.col("n_tokens") <= SAMPLE_TOKENS // 10)).withColumn("place", place)
    least = [r["place"] for r in short.select("place").orderBy("place").limit(SAMPLE_DOCS).collect()]
    chosen = short.where(F.col("place") <= F.lit(max(least, default=0))).orderBy("place").select("classes").limit(SAMPLE_DOCS)
    sample, size = [], 0
    for r in chosen.toLocalIterator() if least else ():
        sample.append(_unplaned(bytes(r["classes"]), 2))
        size += len(sample[-1])
        if size >= SAMPLE_TOKENS:
            break
    for _ in range(FIRST_ROUNDS if sample else 0):
        model = Hmm.from_counts(*model.expected(sample)[:3])
    before = -np.inf
    for _ in range(ROUNDS):
        got = _round(rows, model)
        if got is None:
            break
        model, likelihood = got
        if likelihood - before < SETTLED:
            break
        before = likelihood
    return model


def score(rows: DataFrame, model: Hmm, lexicon: Lexicon) -> DataFrame:
    n = int(lexicon.n)

    def run(batch):
        docs = [_unplaned(d, 2).astype(np.int64) for d in batch.column("classes").to_pylist()]
        total = model.log10(docs) + batch.column("within").to_numpy()
        keep = ["doc_id", "held_out", "n_tokens", "n_known"]
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(np.full(len(docs), n)), batch.column("base_score"), pa.array(total)], names=[*keep, "train_tokens", "base_score", "score"])

    return map_arrow(rows, per_batch(run), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def language_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Hmm, Lexicon]:
    """The stored class sequences of all documents, the trained model and the class totals."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), (crc_mod(F.col(id_col), 7) == 2).alias("held"))
    segments = stored(map_arrow(rows, _segments, SEGMENTS), "segments")
    counts, top, lexicon = count_words(segments)
    release(docs.sparkSession)
    coded = stored(sequences(segments, counts, top, lexicon), "sequences")
    discard(segments)
    discard(counts)
    release(docs.sparkSession)
    return coded, train(coded, lexicon), lexicon


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(*language_model(table(spark, sf_dir, "documents")))


QUERIES = {"op5_lm": op5_lm}
