"""Operator 4: removal of repeated byte strings by a depth-limited radix sort of suffixes.

Every byte position starts a suffix, of which only the first `depth` bytes (the
window) matter.  Suffixes are put into ever smaller buckets, most significant digit
first; a bucket of one is dropped at once, and buckets that hold together through
the last digit are exactly the repeated windows.

First digit: the window's least-hashed `gram`-byte substring.  Neighbouring windows
share it, so a run of windows is one row, found in a scan in linear time.  Equal
windows have equal first digits, so a run whose digit occurs once is done.
Second digit: the whole run of windows.  Runs that occur more than once are repeated
in full, and only one of them stays to be compared with others.
Further digits, over the runs that are alike without being equal: consecutive chunks
of CHUNK bytes of each window of these runs, from its first byte to its last.  A bucket
of up to `crowd` runs is sorted by the remaining digits within a task; a larger one is
dealt out by its digits, one pass over all tasks for each, with counts summed within
tasks first.  Both make the same passes and drop buckets of one after each, and windows
that are still together after the last digit are the repeated ones.

Digits are compared by 64-bit hashes.  Counts use partial sums and joins can split a
hot digit, so a passage or a group of copies that a third of all documents share is
spread.  Spans of a document are merged before they are gathered, so a document's spans
are fewer than its bytes by the depth.

Defined cases: null text counts as empty; repeated rows are copies of one another; a
null id takes part by its text; texts shorter than the depth keep all bytes; very long
texts are scanned in pieces that share all windows across their edges; matches never
cross documents; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm.common import blocks, discard, encoded, map_arrow, per_batch, release, stored, table

DEPTH, GRAM, CHUNK = 200, 64, 40
#: Different runs with one first digit that one task sorts; a larger bucket is dealt out by its further digits.
CROWD = 2000
PIECE = 2 << 20
_WINDOWS_AT_ONCE = 400_000


def _hashes(data: bytes, width: int) -> np.ndarray:
    """A 64-bit hash of each substring of width (8 or more) bytes, by doubling."""
    if len(data) < width:
        return np.empty(0, np.uint64)
    h = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    n = 8
    while n < width:
        step = min(n, width - n)
        h = h[:-step] * np.uint64(0xC2B2AE3D27D4EB4F) + h[step:]
        h ^= h >> np.uint64(29)
        n += step
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of each stretch of width keys, in linear time."""
    rows = -(-len(keys) // width)
    grid = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    grid[: len(keys)] = keys
    grid = grid.reshape(rows, width)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid, axis=1).ravel()
    return np.minimum(ahead[: len(keys) - width + 1], behind[width - 1 : len(keys)])


def runs(texts: list[bytes], depth: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring windows with one first digit: text number, first window, windows, first digit, hash of the run."""
    data, lengths = b"".join(texts), np.array([len(t) for t in texts], np.int64)
    windows = np.maximum(lengths - depth + 1, 0)
    total = int(windows.sum())
    if not total:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    starts = np.cumsum(lengths) - lengths
    digit = _hashes(data, gram)
    keys = (digit & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(digit), dtype=np.uint64)
    least = (_sliding_min(keys, depth - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    del keys
    of = np.repeat(np.arange(len(texts)), windows)
    window = np.repeat(starts - (np.cumsum(windows) - windows), windows) + np.arange(total)
    anchor = least[window]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])]))
    count = np.diff(new, append=total)
    first, of = window[new], of[new]
    hashed = xxhash.xxh3_64_intdigest
    whole = np.fromiter((hashed(data[a:b]) for a, b in zip(first.tolist(), (first + count + depth - 1).tolist())), np.uint64, len(new))
    return of, first - starts[of], count, digit[anchor[new]], whole


def _pieces(texts: list[bytes], depth: int):
    """Texts as (row, offset, piece): long ones in pieces that share depth - 1 bytes, so that every window is in one piece."""
    for k, text in enumerate(texts):
        for at in range(0, max(1, len(text) - depth + 1), PIECE):
            yield k, at, text[at : at + PIECE + depth - 1]


RUNS = "a long, b int, first int, n int, digit long, whole long"


def _scanner(depth, gram):
    def run(batches):
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            pieces = list(_pieces(encoded(batch.column(2)), depth))
            for lo, hi in blocks([p[2] for p in pieces], PIECE):
                of, first, n, digit, whole = runs([p[2] for p in pieces[lo:hi]], depth, gram)
                if len(of):
                    row = np.array([p[0] for p in pieces[lo:hi]])[of]
                    offset = np.array([p[1] for p in pieces[lo:hi]])[of]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (a[row], b[row], (first + offset).astype(np.int32), n.astype(np.int32), digit.view(np.int64), whole.view(np.int64))], names=["a", "b", "first", "n", "digit", "whole"])

    return run


def radix_repeats(data: bytes, bucket: np.ndarray, position: np.ndarray, depth: int) -> np.ndarray:
    """Which of the windows at these positions equal another of the same bucket: most-significant-digit passes over chunks, dropping buckets of one."""
    repeated = np.zeros(len(position), bool)
    alive = np.arange(len(position))
    for at, width in _digits(depth):
        digit = _hashes(data, width)[position[alive] + at]
        order = np.lexsort((digit, bucket[alive]))
        alive, digit, own = alive[order], digit[order], bucket[alive][order]
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (digit[1:] != digit[:-1])])
        number = np.cumsum(new) - 1
        kept = np.bincount(number)[number] > 1
        alive, number = alive[kept], number[kept]
        bucket = bucket.copy()
        bucket[alive] = number
        if not len(alive):
            break
    repeated[alive] = True
    return repeated


def _stretches(flags: np.ndarray, row: np.ndarray, start: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal stretches of flagged neighbouring windows: row, first byte, end of the last window."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at, at
    new = np.concatenate([[True], (row[at][1:] != row[at][:-1]) | (start[at][1:] != start[at][:-1] + 1)])
    last = np.append(np.flatnonzero(new)[1:], len(at)) - 1
    return row[at][new], start[at][new], start[at][last] + depth


SPANS = "a long, b int, start int, stop int"


def _sorter(depth):
    """Sorts the windows of runs that arrive ordered by first digit; a digit's runs stay together."""

    def work(held):
        texts = [x for t in held for x in encoded(t.column("bytes"))]
        column = lambda name: np.concatenate([t.column(name).to_numpy() for t in held])
        a, b, first, digit = column("a"), column("b"), column("first").astype(np.int64), column("digit")
        lengths = np.array([len(t) for t in texts], np.int64)
        n = lengths - depth + 1
        row = np.repeat(np.arange(len(texts)), n)
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        bucket = np.unique(digit, return_inverse=True)[1][row]
        flags = radix_repeats(b"".join(texts), bucket, (np.cumsum(lengths) - lengths)[row] + inner, depth)
        row, start, stop = _stretches(flags, row, first[row] + inner, depth)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (a[row], b[row], start.astype(np.int32), stop.astype(np.int32))], names=["a", "b", "start", "stop"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            digit = batch.column("digit").to_numpy()
            ends = [*(np.flatnonzero(digit[1:] != digit[:-1]) + 1).tolist(), batch.num_rows]
            at = 0
            for end in ends:
                if held and size >= _WINDOWS_AT_ONCE and held[-1].column("digit")[-1].as_py() != digit[at]:
                    yield work(held)
                    held, size = [], 0
                part = batch.slice(at, end - at)
                held.append(part)
                size += sum(len(x.as_py()) for x in part.column("bytes"))
                at = end
        if held:
            yield work(held)

    return run


def _cutter(depth):
    """The bytes of the runs wanted of each document."""

    def run(batch):
        out = ([], [], [], [], [])
        for a, b, text, wanted in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), encoded(batch.column("text")), batch.column("wanted").to_pylist()):
            for w in wanted:
                for column, value in zip(out, (a, b, w["first"], w["digit"], text[w["first"] : w["first"] + w["n"] + depth - 1])):
                    column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()))], names=["a", "b", "first", "digit", "bytes"])

    return per_batch(run)


def _digits(depth: int) -> list[tuple[int, int]]:
    """Places and widths of a window's digits; the last one's overlaps where CHUNK doesn't divide the depth."""
    chunk = min(CHUNK, depth)
    return [(min(at, depth - chunk), chunk) for at in range(0, depth, chunk)]


def _windows(depth):
    """Each window of the runs with its digits, most significant first."""
    digits = _digits(depth)

    def run(batch):
        columns = [batch.column(c).to_pylist() for c in ("a", "b", "first", "digit", "bytes")]
        for lo in range(0, batch.num_rows, 256):
            out = []
            for a, b, first, bucket, data in zip(*(c[lo : lo + 256] for c in columns)):
                n, h = len(data) - depth + 1, _hashes(data, digits[0][1])
                whole = np.broadcast_to
                out.append((whole(np.int64(a), n), whole(np.int32(b), n), (first + np.arange(n)).astype(np.int32), whole(np.int64(bucket), n), *(h[at : at + n].view(np.int64) for at, _ in digits)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["a", "b", "start", "bucket", *(f"d{k}" for k in range(len(digits)))])

    return lambda batches: (out for batch in batches if batch.num_rows for out in run(batch))


def _dealt_passes(rows: DataFrame, depth: int) -> DataFrame:
    """Repeated windows among the runs' bytes, by one pass a digit over all tasks: windows that are alone in their bucket are dropped, the others' bucket takes in the digit."""
    n = len(_digits(depth))
    alive = stored(map_arrow(rows, _windows(depth), "a long, b int, start int, bucket long, " + ", ".join(f"d{k} long" for k in range(n))), "windows")
    for k in range(n):
        key = ["bucket", f"d{k}"]
        together = alive.groupBy(*key).agg(F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
        kept = alive.join(together, key).select("a", "b", "start", F.xxhash64(*key).alias("bucket"), *[f"d{j}" for j in range(k + 1, n)])
        alive, old = stored(kept, "windows"), alive
        discard(old)
    return alive.select("a", "b", "start", (F.col("start") + depth).cast("int").alias("stop"))


def _merger(batches):
    """Rows sorted by document and start: overlapping and touching spans of a document joined."""
    names, held = ["a", "b", "start", "stop"], None
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, start, stop = (batch.column(c).to_numpy() for c in names)
        if held is not None:
            a, b, start, stop = (np.concatenate([[h], c]).astype(c.dtype) for h, c in zip(held, (a, b, start, stop)))
        other = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        # the furthest end so far in the document: ends grow from document to document by an offset
        base = np.cumsum(other).astype(np.int64) << 32
        far = np.maximum.accumulate(base + stop)
        new = other | np.concatenate([[True], base[1:] + start[1:] > far[:-1]])
        at = np.flatnonzero(new)
        end = (far[np.append(at[1:], len(a)) - 1] & 0xFFFFFFFF).astype(np.int32)
        held = (a[at[-1]], b[at[-1]], start[at[-1]], end[-1])
        at, end = at[:-1], end[:-1]
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(a[at]), pa.array(b[at]), pa.array(start[at]), pa.array(end)], names=names)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([h], t) for h, t in zip(held, (pa.int64(), pa.int32(), pa.int32(), pa.int32()))], names=names)


def _located(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with a locator (a, b): the id (for a null id, part of the text's hash) and the rest of that hash; equal for copies with one id."""
    h = F.xxhash64(F.col(text_col))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.shiftright(h, 32)).alias("a"), h.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("b"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def repeated_spans(docs: DataFrame, depth: int = DEPTH, gram: int = GRAM, crowd: int = CROWD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (a, b, start, stop), stored: the maximal byte spans covered by windows that also start elsewhere."""
    spark = docs.sparkSession
    texts = _located(docs, id_col, text_col).select("a", "b", "text")
    found = stored(map_arrow(texts, _scanner(depth, gram), RUNS), "runs")
    by_whole = found.groupBy("digit", "whole").agg(F.count(F.lit(1)).alias("c"))
    by_whole = stored(by_whole, "run-counts")
    release(spark)
    kinds = by_whole.groupBy("digit").agg(F.sum("c").alias("all"), F.count(F.lit(1)).alias("different")).where(F.col("all") > 1).drop("all")
    alive = stored(by_whole.join(kinds, "digit").select("digit", "whole", (F.col("c") > 1).alias("full"), "different"), "buckets")
    discard(by_whole)
    kept = stored(found.join(alive, ["digit", "whole"]), "kept-runs")
    discard(found)
    release(spark)
    full = kept.where("full").select("a", "b", F.col("first").alias("start"), (F.col("first") + F.col("n") + (depth - 1)).cast("int").alias("stop"))
    alike = kept.where("different > 1")
    one = alike.where("full").groupBy("digit", "whole", "different").agg(F.min(F.struct("a", "b", "first", "n")).alias("r")).select("r.a", "r.b", "r.first", "r.n", "digit", "different")
    wanted = alike.where("not full").select("a", "b", "first", "n", "digit", "different").unionByName(one)

    def bytes_of(rows):
        of_doc = rows.groupBy("a", "b").agg(F.collect_set(F.struct("first", "n", "digit")).alias("wanted"))
        copies = texts.join(of_doc, ["a", "b"])
        return map_arrow(copies, _cutter(depth), "a long, b int, first int, digit long, bytes binary")

    few = bytes_of(wanted.where(F.col("different") <= crowd))
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spans = full.unionByName(map_arrow(few.repartition(shards, "digit").sortWithinPartitions("digit"), _sorter(depth), SPANS))
    if wanted.where(F.col("different") > crowd).limit(1).count():
        spans = spans.unionByName(_dealt_passes(bytes_of(wanted.where(F.col("different") > crowd)), depth))
    # rows that repeat a document have its spans more than once: one of each start leaves a task
    spans = spans.groupBy("a", "b", "start").agg(F.max("stop").alias("stop"))
    out = stored(map_arrow(spans.repartition(shards, "a", "b").sortWithinPartitions("a", "b", "start"), _merger, SPANS), "spans")
    release(spark)
    return out


def remove_repeats(docs: DataFrame, depth: int = DEPTH, gram: int = GRAM, crowd: int = CROWD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, n_bytes, the removed spans and the kept bytes."""
    spans = repeated_spans(docs, depth, gram, crowd, id_col, text_col)
    of_doc = spans.groupBy("a", "b").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    rows = _located(docs, id_col, text_col).join(of_doc, ["a", "b"], "left")

    def run(batch):
        ids, texts = batch.column("doc_id"), encoded(batch.column("text"))
        removed, kept = [], []
        for text, spans in zip(texts, batch.column("spans").to_pylist()):
            own, at, left = [(s["start"], s["stop"]) for s in spans or ()], 0, []
            for start, stop in own:
                left.append(text[at:start])
                at = stop
            kept.append(b"".join(left) + text[at:])
            removed.append([{"start": s, "stop": e} for s, e in own])
        return pa.RecordBatch.from_arrays([ids, pa.array([len(t) for t in texts], pa.int64()), pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "removed", "kept"])

    return map_arrow(rows, per_batch(run), "doc_id long, n_bytes long, removed array<struct<start:int,stop:int>>, kept binary")


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + (s["stop"] - s["start"]))
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op4_repeats": op4_repeats}
