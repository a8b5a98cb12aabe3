"""Operator 2: best-fit packing of documents into sequences of a fixed capacity.

Bulk-synchronous best fit.  The state is two stored tables: waiting pieces (length, uid)
and open gaps (gap, sequence).  A superstep

1. offers the gaps: one that holds the longest piece that fits it several times is
   offered as so many slots, so that short pieces need few supersteps; where the gaps
   can't hold what waits, new sequences are opened, as gaps of the whole capacity;
2. range-sorts pieces and slots together by size, pieces before slots of one size; each
   range counts how many of its pieces are still without a slot as it goes upwards (its
   sweep), and the ranges' totals, one number each, tie the sweeps together;
3. matches by rank: a piece and the next slot above it at the same level of that count
   are successor and claimant of one another, so of the claimants of a slot the longest
   gets it, and every other goes on to the next slot; no slot is given twice;
4. updates the gaps of the sequences that got pieces, and repeats.

Levels are shared by few rows (twice the capacity at most: each run of equal sizes
passes a level once), whatever lengths are frequent, so no row waits in a hot group.
Pieces that fill a sequence alone are placed at once.  What reaches the driver are
counts by length and by gap (capacity numbers each) and one number a range.

Defined cases: null text counts as empty and gives one piece, the end id; repeated
rows are packed each; equal lengths are ranked by where their rows were read; a very
long text is cut into pieces of the capacity; an empty table gives no rows; extra
columns are ignored.  Of a document that is cut, the first piece has what is left over
from whole ones.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsift.llm import bpe
from docsift.llm.common import blocks, discard, map_arrow, per_batch, stored, table

PIECES = "uid long, doc_id long, piece int, start long, length int, ids_crc32 long"
#: Rows that one range of a superstep sorts at about.
RANGE_ROWS = 500_000
_UID_BITS = 36


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of n ids: whole pieces, after a shorter first one where n doesn't divide."""
    first = n % capacity
    return ([first] if first else []) + [capacity] * (n // capacity)


def _cutter(vocabulary: str, capacity: int, end_id: int):
    def run(batches):
        uid = TaskContext.get().partitionId() << _UID_BITS
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            doc_ids = batch.column(0).to_pylist()
            for lo, hi in blocks(texts, bpe.BLOCK_BYTES):
                ids, bounds = bpe.encoder(vocabulary).encode(texts[lo:hi], end_id)
                rows = []
                for k in range(hi - lo):
                    at, start = int(bounds[k]), 0
                    for piece, length in enumerate(cut_lengths(int(bounds[k + 1]) - at, capacity)):
                        rows.append((uid + len(rows), doc_ids[lo + k], piece, start, length, zlib.crc32(ids[at + start : at + start + length])))
                        start += length
                uid += len(rows)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["uid", "doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def cut_documents(docs: DataFrame, capacity: int = 2048, vocabulary: str | None = None, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per piece of every document: a number of its own, its place in the document and a checksum of its ids. Store it before use: numbers follow the partitions read."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(rows, _cutter(vocabulary or bpe.default_path(), capacity, end_id), PIECES)


def _counts(rows: DataFrame, size: str, capacity: int) -> np.ndarray:
    """How many rows there are of each size up to the capacity."""
    out = np.zeros(capacity + 1, np.int64)
    for r in rows.groupBy(size).count().collect():
        out[r[size]] = r["count"]
    return out


def fitting(waiting: np.ndarray) -> np.ndarray:
    """For each gap, the longest waiting length that fits it (0: none)."""
    return np.maximum.accumulate(np.where(waiting > 0, np.arange(len(waiting)), 0))


def to_open(waiting: np.ndarray, gaps: np.ndarray, first: bool) -> int:
    """New sequences of a superstep: what the tokens that wait need beyond the gaps that can take any, at first one for each piece over half the capacity."""
    capacity, size = len(waiting) - 1, np.arange(len(waiting))
    if not waiting.any():
        return 0
    usable = gaps * (size >= np.flatnonzero(waiting)[0])
    need = -(-max(0, int((waiting * size).sum() - (usable * size).sum())) // capacity)
    if first:
        need = max(need, int(waiting[capacity // 2 + 1 :].sum()))
    return need if need or usable.any() else 1


def _offers(longest: np.ndarray):
    """Slots of gaps: as many as the longest fitting piece goes into one, the first with what is left over."""

    def run(batch):
        gap, sequence = batch.column("gap").to_numpy(), batch.column("sequence").to_numpy()
        each = longest[gap]
        gap, sequence, each = gap[each > 0], sequence[each > 0], each[each > 0]
        n = gap // each
        ends = np.cumsum(n)
        slot = np.arange(n.sum()) - np.repeat(ends - n, n)
        value = np.repeat(each, n)
        value[ends - n] += gap - n * each
        return pa.RecordBatch.from_arrays([pa.array(value.astype(np.int32)), pa.array(np.ones(len(value), np.int32)), pa.array(np.repeat(sequence, n)), pa.array(slot.astype(np.int32))], names=_ROW)

    return per_batch(run)


_ROW = ["value", "kind", "id", "slot"]
_ORDER = ("value", "kind", "id", "slot")


def _sweep(batches):
    """A range in order: its rows with the count, so far in the range, of pieces less slots."""
    part, depth = TaskContext.get().partitionId(), 0
    for batch in batches:
        if batch.num_rows:
            after = depth + np.cumsum(1 - 2 * batch.column("kind").to_numpy().astype(np.int64))
            depth = int(after[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(after)], names=[*_ROW, "part", "depth"])


def matched(waiting: DataFrame, gaps: DataFrame, longest: np.ndarray, ranges: int) -> DataFrame:
    """One sweep, stored: pieces (kind 0) and slots (kind 1) with the id and size of what each is matched to, or null."""
    spark = waiting.sparkSession
    pieces = waiting.select(F.col("length").alias("value"), F.lit(0).alias("kind"), F.col("uid").alias("id"), F.lit(0).alias("slot"))
    slots = map_arrow(gaps.select("gap", "sequence"), _offers(longest), "value int, kind int, id long, slot int")
    dealt = pieces.unionByName(slots).repartitionByRange(ranges, *_ORDER).sortWithinPartitions(*_ORDER)
    swept = stored(map_arrow(dealt, _sweep, "value int, kind int, id long, slot int, part int, depth long"), "swept")
    totals, before = sorted((r["part"], r["n"]) for r in swept.groupBy("part").agg(F.sum(1 - 2 * F.col("kind")).alias("n")).collect()), 0
    bases = []
    for part, n in totals:
        bases.append((part, before))
        before += n
    bases = spark.createDataFrame(bases, "part int, base long")
    # a slot closes the level that the piece it gets has opened; bases has a row a range
    level = F.col("depth") + F.col("base") + F.col("kind")
    w = Window.partitionBy("level").orderBy(*_ORDER)
    near = swept.join(F.broadcast(bases), "part").withColumn("level", level)
    ahead = [F.lead(c).over(w).alias(f"next_{c}") for c in ("kind", "id", "value")]
    behind = [F.lag(c).over(w).alias(f"last_{c}") for c in ("kind", "id", "value")]
    sided = near.select(*_ROW, *ahead, *behind)
    met = F.when(F.col("kind") == 0, F.col("next_kind") == 1).otherwise(F.col("last_kind") == 0)
    pick = lambda c: F.when(met, F.when(F.col("kind") == 0, F.col(f"next_{c}")).otherwise(F.col(f"last_{c}"))).alias(f"other_{c}")
    out = stored(sided.select(*_ROW, pick("id"), pick("value")), "matched")
    discard(swept)
    return out


def _updated(match: DataFrame, gaps: DataFrame, capacity: int) -> DataFrame:
    """Stored rows of sequences after a sweep: their pieces (uid, place) and, with a null uid, the gap that is left."""
    taken = match.where("kind = 1 and other_id is not null").select(F.col("id").alias("sequence"), F.lit(0).alias("gap"), F.col("other_value").alias("length"), F.col("other_id").alias("uid"))
    rows = gaps.select("sequence", "gap", F.lit(0).alias("length"), F.lit(None).cast("long").alias("uid")).unionByName(taken)
    whole = Window.partitionBy("sequence")
    upto = whole.orderBy(F.desc("length"), "uid").rowsBetween(Window.unboundedPreceding, -1)
    gap = F.sum("gap").over(whole)
    place = F.lit(capacity) - gap + F.coalesce(F.sum("length").over(upto), F.lit(0))
    left = gap - F.sum("length").over(whole)
    return stored(rows.select("sequence", "uid", place.alias("place"), left.cast("int").alias("gap")), "sequences")


def places(waiting: DataFrame, capacity: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(uid, sequence, place) of pieces (uid, length) below the capacity: supersteps until none waits."""
    spark, done, opened = waiting.sparkSession, [], 0
    gaps = spark.createDataFrame([], "gap int, sequence long")
    lengths, sizes = _counts(waiting, "length", capacity), np.zeros(capacity + 1, np.int64)
    last: list[DataFrame] = []
    while lengths.any():
        new = to_open(lengths, sizes, not opened)
        if new:
            gaps = gaps.unionByName(spark.range(opened, opened + new).select(F.lit(capacity).alias("gap"), F.col("id").alias("sequence")))
            sizes[capacity] += new
            opened += new
        longest = fitting(lengths)
        slots = int((sizes * np.where(longest > 0, np.arange(capacity + 1) // np.maximum(longest, 1), 0)).sum())
        match = matched(waiting, gaps, longest, max(1, -(-(int(lengths.sum()) + slots) // range_rows)))
        state = _updated(match, gaps, capacity)
        done.append(state.where("uid is not null").select("uid", "sequence", "place"))
        waiting = match.where("kind = 0 and other_id is null").select(F.col("value").alias("length"), F.col("id").alias("uid"))
        gaps = state.where("uid is null and gap > 0").select("gap", "sequence")
        for old in last:
            discard(old)
        last = [match]
        lengths, sizes = _counts(waiting, "length", capacity), _counts(gaps, "gap", capacity)
    return reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], "uid long, sequence long, place long")


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Give every piece (of a stored table) a sequence and an offset there."""
    columns = ["doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32"]
    full = pieces.where(F.col("length") == capacity).select(*columns, (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("length") < capacity)
    found = places(rest.select("length", "uid"), capacity)
    return full.unionByName(rest.join(found, "uid").select(*columns, F.col("sequence").alias("sequence_id"), F.col("place").cast("long").alias("offset")))


def best_fit_packing(docs: DataFrame, capacity: int = 2048, vocabulary: str | None = None, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut, then pack: one row per piece with its sequence and offset."""
    return pack(stored(cut_documents(docs, capacity, vocabulary, end_id, id_col, text_col), "pieces"), capacity)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"))


QUERIES = {"op2_packing": op2_packing}
