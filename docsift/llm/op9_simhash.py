"""Operator 9: SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits.  Of two fingerprints that
differ in three bits at most, one segment differs in one bit at most, so they share
that segment, or share it once the differing bit is cut out.  Every distinct
fingerprint is indexed under both segments and under each segment with one bit cut
out; equality joins find the candidates (of the cut variants only pairs whose cut
bit differs, so a pair comes up twice at most) and the whole fingerprints verify
them.  Copies share a fingerprint, so joins see a group of copies once.

A segment that very many distinct fingerprints share would make a large bucket.
Such buckets are indexed once more, exactly, by the other segment: its two halves of
16 bits with at most one bit cut out (of three differing bits one half has one at
most).  Nothing is capped.

Defined cases: null or wordless texts have fingerprint zero and link like any other;
fewer words than a shingle make one shingle; repeated rows are kept; a null doc_id
takes part but is never a component's id unless all its ids are null; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsift.llm.common import LOWER, discard, encoded, free_name, map_arrow, per_batch, release, stored, table
from docsift.operators.components import connected_components

SHINGLE, DISTANCE = 3, 3
#: Distinct fingerprints that share a segment; above it the buckets around are indexed once more.
HEAVY = 2000
_BITS_AT_ONCE = 1 << 16


def fingerprint(text: bytes, width: int = SHINGLE, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles, repeats included; zero without words."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[min(width, len(words)) - 1 :].tolist())), "<u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _BITS_AT_ONCE):
        part = hashes[at : at + _BITS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """A row per document: doc_id and its fingerprint as a signed 64-bit number."""

    def run(batch):
        prints = np.fromiter((fingerprint(t, width) for t in encoded(batch.column(1))), np.uint64, batch.num_rows)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), per_batch(run), "doc_id long, fp long")


def _segment(fp: Column, which: Column) -> Column:
    return F.when(which == 0, fp.bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned(fp, 32))



def _index(prints: DataFrame) -> DataFrame:
    """Rows (key, side, fp): bit 32 stands for the whole segment, others for the bit cut out; side is that bit."""
    rows = prints.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("seg")).withColumn("value", _segment(F.col("fp"), F.col("seg")))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(32))).alias("bit"))
    return rows.select(
        F.expr("shiftleft(cast(seg as bigint), 40) | shiftleft(cast(bit as bigint), 33) | if(bit = 32, value, value & ~shiftleft(1L, bit))").alias("key"),
        F.expr("if(bit = 32, 2, cast(shiftright(value, bit) & 1 as int))").alias("side"),
        "fp",
        "seg",
    )


def _refined(rows: DataFrame) -> DataFrame:
    """For heavy buckets: the other segment's halves, whole or with one bit cut out, as a second key."""
    other = rows.withColumn("other", _segment(F.col("fp"), 1 - F.col("seg")))
    halves = other.select("*", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("half")).withColumn("part", F.expr("shiftright(other, 16 * half) & 65535"))
    return halves.select("*", F.explode(F.sequence(F.lit(0), F.lit(16))).alias("gone")).withColumn("sub", F.expr("1 + (shiftleft(cast(half as bigint), 40) | shiftleft(cast(gone as bigint), 20) | if(gone = 16, part, part & ~shiftleft(1L, gone)))"))


def links(prints: DataFrame, distance: int = DISTANCE, heavy: int = HEAVY) -> DataFrame:
    """Distinct pairs (src, dst) of fingerprints at most `distance` (3 or fewer) bits apart; prints has one row per fingerprint."""
    if not 0 <= distance <= 3:
        raise ValueError("two segments with one bit cut out find up to three differing bits")
    segments = prints.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("seg")).withColumn("value", _segment(F.col("fp"), F.col("seg")))
    crowded = stored(segments.groupBy("seg", "value").count().where(F.col("count") > heavy).select("seg", "value"), "crowded")
    rows = _index(prints).withColumn("sub", F.lit(0).cast("long"))
    if crowded.limit(1).count():
        around = crowded.select("seg", "value", F.explode(F.sequence(F.lit(0), F.lit(32))).alias("bit"))
        # stored, so that Spark knows how many they are before it sends them anywhere
        keys = stored(around.select(F.expr("shiftleft(cast(seg as bigint), 40) | shiftleft(cast(bit as bigint), 33) | if(bit = 32, value, value & ~shiftleft(1L, bit))").alias("key")).distinct(), "crowded-keys")
        dense = _refined(rows.drop("sub").join(keys, "key", "left_semi")).select(rows.columns)
        rows = rows.join(keys, "key", "left_anti").unionByName(dense)
    rows = rows.drop("seg")
    close = lambda l, r: F.bit_count(F.col(l).bitwiseXOR(F.col(r))) <= distance
    # the hints: Spark takes an exploded index for as small as its fingerprints, and would broadcast it through the driver
    whole = rows.where("side = 2").drop("side")
    same = whole.withColumnRenamed("fp", "src").join(whole.withColumnRenamed("fp", "dst").hint("merge"), ["key", "sub"]).where((F.col("src") < F.col("dst")) & close("src", "dst"))
    zero, one = rows.where("side = 0").drop("side").withColumnRenamed("fp", "src"), rows.where("side = 1").drop("side").withColumnRenamed("fp", "dst")
    cut = zero.join(one.hint("merge"), ["key", "sub"]).where(close("src", "dst"))
    return same.select("src", "dst").unionByName(cut.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """A row per document: doc_id, fp, component_id (the smallest doc_id reachable over links) and component_fp (one fingerprint that stands for the component)."""
    rows = stored(fingerprints(docs, id_col, text_col, width), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    pairs = links(classes.select("fp"), distance)
    roots = connected_components(pairs, lambda df: stored(df, "links"))
    placed = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component_fp", F.coalesce("root", "fp"))
    firsts = placed.groupBy("component_fp").agg(F.min("first").alias("component_id"))
    of_class = placed.select("fp", "component_fp").join(firsts, "component_fp")
    return rows.join(of_class, "fp").select("doc_id", "fp", "component_id", "component_fp")


# --- one document of each group of near copies ------------------------------------------------------------------------

WORDS, SIMILARITY = 5, 0.8
#: Texts whose shingles are counted to tell common ones, the count that makes one common, and the most that are told; they order prefixes and bear on time only.
COUNTED, COMMON, TOLD = 10_000, 3, 200_000
#: Pairs that a sweep gathers for a batch, and those that it tests at a time.
_PAIRS_AT_ONCE, _TESTED_AT_ONCE = 1 << 19, 1 << 17
#: Texts that each text is tested against first, texts of other groups that it is then tested against at a time, and how often so; they bear on time only, as all other pairs follow.
HEADS, TRIES, JOININGS = 2, 8, 1
#: Bits of a text's parities, which rule pairs out before whole sets meet.
PARITY, FOLDED = 1024, 256


class _Hashes(dict):
    """Hashes of words, each computed once until there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hash_of = _Hashes()
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def shingle_set(text: bytes, width: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles (fewer words: the whole sequence), each of its words' hashes in order."""
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(1, np.uint64)
    own = np.fromiter(map(_hash_of.__getitem__, words), np.uint64, len(words))
    n, width = max(1, len(words) - width + 1), min(width, len(words))
    h = np.full(n, width, np.uint64)
    for k in range(width):
        h = (h ^ h >> np.uint64(31)) * _STEP + own[k : k + n]
    h = (h ^ h >> np.uint64(29)) * _MIX
    return np.unique(h ^ h >> np.uint64(32))


def prefix(s: np.ndarray, common: np.ndarray, rank: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles of a set, common ones last: sets of at least this similarity share one of these."""
    wanted = len(s) - int(np.ceil(similarity * len(s) - 1e-9)) + 1
    if len(common):
        at = np.minimum(np.searchsorted(common, s), len(common) - 1)
        s = s[np.lexsort((s, np.where(common[at] == s, rank[at], 0)))]
    return s[:wanted]


def _prefixes(width: int, similarity: float, common: np.ndarray, rank: np.ndarray):
    """Rows (key, node, size, pos): a text's prefix shingles with the size of its set; of copies in a task one."""

    def run(batches):
        seen = set()
        for batch in batches:
            nodes, keys, sizes, counts = [], [], [], []
            for node, text in zip(batch.column(0).to_pylist(), encoded(batch.column(1))):
                if node not in seen:
                    seen.add(node)
                    s = shingle_set(text, width)
                    keys.append(prefix(s, common, rank, similarity))
                    nodes.append(node)
                    sizes.append(len(s))
                    counts.append(len(keys[-1]))
            if nodes:
                pos = np.concatenate([np.arange(c, dtype=np.int32) for c in counts])
                made = [np.concatenate(keys).view(np.int64), np.repeat(np.array(nodes, np.int64), counts), np.repeat(np.array(sizes, np.int32), counts), pos]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], names=["key", "node", "size", "pos"])

    return run


def _shared(batches):
    """Rows sorted by key, size and node: those of keys with several nodes, each with the key's first node as head."""
    names = ["key", "node", "size", "pos", "head"]
    held, kept = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy() for k in range(4)]
        if held is not None:
            cols = [np.concatenate([[h], c]).astype(c.dtype) for h, c in zip(held, cols)]
        key, node = cols[0], cols[1]
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])
        cols = [c[fresh] for c in cols]
        key = cols[0]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first = cols[1][new]
        if held is not None:
            first[0] = held[4]
        head = first[np.cumsum(new) - 1]
        keep = ~new
        keep[:-1] |= ~new[1:]
        keep[0] |= held is not None and kept
        held, kept = [*(c[-1] for c in cols), head[-1]], bool(keep[-1])
        keep[-1] = False
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (*cols, head)], names=names)
    if held is not None and kept:
        yield pa.RecordBatch.from_arrays([pa.array([h], t) for h, t in zip(held, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()))], names=names)


def _across(node, size, pos, group, bits, similarity, one=0):
    """Pairs of one key's rows, sorted by size, of different groups that sizes, places and folded parities leave a chance; one (other than 0): for each row one pair that it may have, picked by a hash of it and this number."""
    names, of = np.unique(group, return_inverse=True)
    if len(names) == 1:
        return
    most = np.bincount(of).argmax()
    few = np.flatnonzero(of != most)
    low = np.searchsorted(size, np.ceil(similarity * size[few] - 1e-9), "left")
    high = np.searchsorted(size, np.floor(size[few] / similarity + 1e-9), "right")
    if one:
        mixed = (node[few].view(np.uint64) ^ np.uint64(one)) * np.uint64(0x9E3779B97F4A7C15)
        low = low + ((mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)).astype(np.int64) % (high - low)
        high = low + 1
    many = np.cumsum(high - low)
    start = 0
    while start < len(few):
        stop = max(start + 1, int(np.searchsorted(many, (many[start - 1] if start else 0) + _TESTED_AT_ONCE, "right")))
        n = (high - low)[start:stop]
        i = np.repeat(few[start:stop], n)
        j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[start:stop], n)
        chance = np.minimum(size[i] - pos[i], size[j] - pos[j]) >= similarity / (1 + similarity) * (size[i] + size[j]) - 1e-6
        fits = chance & (of[i] != of[j]) & ((of[j] == most) | (i < j))
        i, j = i[fits], j[fits]
        least = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)
        fits = least <= (1 - similarity) / (1 + similarity) * (size[i] + size[j]) + 1e-6
        if fits.any():
            yield np.maximum(node[i[fits]], node[j[fits]]), np.minimum(node[i[fits]], node[j[fits]])
        start = stop


def _between(similarity: float, one: int = 0):
    """Rows (key, node, size, pos, group, bits) sorted by key, size and node: pairs (src, dst) of a key whose groups differ, once a batch at most; one (other than 0): for each row one pair at most."""

    def made(rows):
        key, node, size, pos, group, bits = (np.concatenate(c) for c in zip(*rows))
        ends = np.flatnonzero(np.concatenate([key[1:] != key[:-1], [True]])) + 1
        for a, b in zip(np.concatenate([[0], ends[:-1]]), ends):
            yield from _across(node[a:b], size[a:b].astype(np.int64), pos[a:b].astype(np.int64), group[a:b], bits[a:b], similarity, one and (one * 1_000_003 ^ int(key[a])) & 0xFFFFFFFFFFFFFFF | 1)

    def said(rows):
        src, dst, n = [], [], 0
        for x, y in made(rows):
            src.append(x)
            dst.append(y)
            n += len(x)
            if n >= _PAIRS_AT_ONCE:
                yield batch_of(src, dst)
                src, dst, n = [], [], 0
        if src:
            yield batch_of(src, dst)

    def batch_of(src, dst):
        pairs = np.unique(np.stack([np.concatenate(src), np.concatenate(dst)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["src", "dst"])

    def run(batches):
        rows = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(k).to_numpy() for k in range(5)]
            cols.append(np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint64).reshape(batch.num_rows, -1))
            last = int(np.searchsorted(cols[0], cols[0][-1]))
            if last or (rows and rows[-1][0][-1] != cols[0][0]):
                yield from said([*rows, [c[:last] for c in cols]])
                rows = []
            rows.append([c[last:] for c in cols])
        if rows:
            yield from said(rows)

    return run


def parity(s: np.ndarray, bits: int = PARITY) -> np.ndarray:
    """For each value of hash mod bits, whether an odd number of shingles has it; two sets differ in as many shingles as bits here, or more."""
    return np.packbits(np.bincount((s % np.uint64(bits)).astype(np.int64), minlength=bits) & 1)


def folded(b: bytes) -> bytes:
    """The parities of hash mod FOLDED, from those of hash mod PARITY."""
    return np.bitwise_xor.reduce(np.frombuffer(b, np.uint8).reshape(-1, FOLDED // 8), axis=0).tobytes()


def _possible(similarity: float):
    """Keeps pairs whose parities and sizes allow the similarity; no similar pair is lost."""

    def run(batch):
        bits = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("ba", "bb")]
        least = np.bitwise_count(bits[0] ^ bits[1]).sum(axis=1, dtype=np.int64)
        fits = least <= (1 - similarity) / (1 + similarity) * (batch.column("na").to_numpy() + batch.column("nb").to_numpy()) + 1e-6
        return batch.select(["src", "dst", "count"]).filter(pa.array(fits))

    return per_batch(run)


def _views(column: pa.Array):
    """The shingle sets of a column without nulls, read in place."""
    ends = np.frombuffer(column.buffers()[1], np.int32 if pa.types.is_binary(column.type) else np.int64)[column.offset : column.offset + len(column) + 1]
    values = column.buffers()[2]
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield np.frombuffer(values, np.uint64, (b - a) // 8, a)


def _alike(similarity: float):
    def run(batch):
        keep = []
        for a, b in zip(_views(batch.column("sa")), _views(batch.column("sb"))):
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(both >= similarity * (len(a) + len(b) - both))
        return pa.RecordBatch.from_arrays([batch.column("src"), batch.column("dst")], names=["src", "dst"]).filter(pa.array(keep))

    return per_batch(run)


def _common(texts: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of shingles that many of a bounded number of texts hold, and their ranks, the most common last."""
    share = min(1.0, COUNTED / max(1, texts.count()))
    some = texts.where(F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < int(share * 1_000_000)) if share < 1 else texts

    def run(batch):
        made = {n: shingle_set(t, width) for n, t in zip(batch.column(0).to_pylist(), encoded(batch.column(1)))}
        sizes = [len(s) for s in made.values()]
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(list(made), np.int64), sizes)), pa.array(np.concatenate(list(made.values())).view(np.int64))], names=["node", "key"])

    found = map_arrow(some, per_batch(run), "node long, key long").groupBy("key").agg(F.count_distinct("node").alias("n"))
    got = found.where(F.col("n") >= COMMON).orderBy(F.desc("n"), "key").limit(TOLD).collect()
    hashes = np.array([r["key"] for r in got], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.array([r["n"] for r in got], np.int64)[order]


def near_copies(docs: DataFrame, text_col: str = "text", width: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(node, root) for texts, by xxhash64, that are linked to others by shingle sets of at least this similarity.

    Candidates come from an exact prefix filter: in any fixed order of all shingles, two
    sets of at least this similarity share one of their first shingles, so many as the
    similarity lets differ, and one.  The order puts common shingles last.  First each
    text is tested against HEADS texts that it shares most such shingles with, then a few
    times against TRIES texts in other groups; then all pairs that share one, are still in
    different groups, and that sizes, places and parities leave a chance.
    Tests are exact, on whole shingle sets.  Nothing is capped or sampled.
    """
    spark = docs.sparkSession
    texts = docs.select(F.xxhash64(text_col).alias("node"), F.col(text_col).alias("text"))
    common, rank = _common(texts, width)
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = map_arrow(texts, _prefixes(width, similarity, common, rank), "key long, node long, size int, pos int")
    keyed = keyed.repartition(shards, "key").sortWithinPartitions("key", "size", "node")
    shared = stored(map_arrow(keyed, _shared, "key long, node long, size int, pos int, head long"), "shared-shingles")
    release(spark)
    nodes = shared.select("node").distinct()

    def bits(batch):
        made = [shingle_set(t, width) for t in encoded(batch.column(1))]
        parities = [parity(m).tobytes() for m in made]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(parities, pa.binary()), pa.array(map(folded, parities), pa.binary()), pa.array([len(m) for m in made], pa.int32())], names=["node", "b", "bits", "n"])

    def sets(batch):
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(t, width).tobytes() for t in encoded(batch.column(1))], pa.binary())], names=["node", "s"])

    parities = map_arrow(texts, per_batch(bits), "node long, b binary, bits binary, n int").dropDuplicates(["node"]).join(nodes.hint("merge"), "node", "left_semi")
    parities = stored(parities, "parities")
    release(spark)

    def possible(pairs):
        sided = pairs.join(parities.select(F.col("node").alias("src"), F.col("b").alias("ba"), F.col("n").alias("na")), "src").join(parities.select(F.col("node").alias("dst"), F.col("b").alias("bb"), F.col("n").alias("nb")), "dst")
        return stored(map_arrow(sided.select("src", "dst", "count", "ba", "na", "bb", "nb"), _possible(similarity), "src long, dst long, count long"), "possible")

    def some(pairs, n, *order):
        """The first n pairs of each text."""
        place = F.row_number().over(Window.partitionBy("src").orderBy(*order, "dst"))
        return pairs.withColumn("place", place).where(F.col("place") <= n).drop("place")

    def grouped(links):
        """The shared shingles with the groups so far, sorted as the sweeps want them."""
        roots = stored(connected_components(links, lambda df: stored(df, "links")), "roots")
        of = parities.select("node", "bits").join(roots.withColumnRenamed("root", "group"), "node", "left").withColumn("group", F.coalesce("group", "node"))
        rows = shared.drop("head").join(of, "node")
        return rows.select("key", "node", "size", "pos", "group", "bits").repartition(shards, "key").sortWithinPartitions("key", "size", "node")

    def tested(pairs):
        ends = pairs.select("src").union(pairs.select("dst")).distinct().withColumnRenamed("src", "node")
        # one text of each node leaves a task, however many copies it has; the hint keeps the plan alike at every size
        wanted = texts.groupBy("node").agg(F.first("text").alias("text")).join(ends.hint("merge"), "node", "left_semi")
        shingles = stored(map_arrow(wanted, per_batch(sets), "node long, s binary"), "shingle-sets")
        release(spark)
        sided = pairs.join(shingles.select(F.col("node").alias("src"), F.col("s").alias("sa")), "src").join(shingles.select(F.col("node").alias("dst"), F.col("s").alias("sb")), "dst")
        out = stored(map_arrow(sided.select("src", "dst", "sa", "sb"), _alike(similarity), "src long, dst long"), "alike")
        discard(shingles)
        release(spark)
        return out

    heads = shared.where("node != head").groupBy(F.greatest("node", "head").alias("src"), F.least("node", "head").alias("dst"), "node").count()
    heads = heads.groupBy("src", "dst").agg(F.sum("count").alias("count"))
    alike = tested(stored(some(possible(heads), HEADS, F.desc("count")).select("src", "dst"), "candidates"))
    for k in range(1, JOININGS + 1):
        found = map_arrow(grouped(alike), _between(similarity, one=k), "src long, dst long").distinct()
        found = stored(some(found, TRIES, F.xxhash64("src", "dst")).withColumn("count", F.lit(0).cast("long")), "candidates")
        release(spark)
        more = tested(possible(found).select("src", "dst"))
        if not more.limit(1).count():
            break
        alike = alike.unionByName(more)
    left = map_arrow(grouped(alike), _between(similarity), "src long, dst long").distinct()
    left = stored(left.select("src", "dst", F.lit(0).cast("long").alias("count")), "open-pairs")
    release(spark)
    left = possible(left).select("src", "dst")
    return connected_components(alike.unionByName(tested(left)), lambda df: stored(df, "links"))


def _firsts(docs: DataFrame, roots: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs with one row of each root, that of the smallest id; roots: (node, root) for texts by xxhash64, others stand alone."""
    # a text's least id first, so that copies meet before texts meet their roots
    named = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("node")).groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "node")).alias("k"))
    placed = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    key = free_name(docs, "near_dedup_key")
    keepers = placed.groupBy("root").agg(F.min("k").alias("k")).select(F.xxhash64("k.id", "k.node").alias(key))
    picked = docs.withColumn(key, F.xxhash64(F.col(id_col), F.xxhash64(text_col))).join(keepers, key, "left_semi")
    return picked.dropDuplicates([key]).select(docs.columns)


def one_of_each(docs: DataFrame, width: int = WORDS, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of near copies by shingle sets, that of the smallest id (of equal ids, of the smallest text hash).

    Defined cases: null texts are copies of one another, and so are empty and wordless
    texts; of repeated rows one stays; a null id stays only where its group has no
    other; very long texts are compared whole; an empty table gives no rows; other
    columns are kept as they are, whatever their names.
    """
    return _firsts(docs, near_copies(docs, text_col, width, similarity), id_col, text_col)


def one_of_each_component(docs: DataFrame, width: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component of near_duplicates(), that of the smallest id (of equal ids, of the smallest text hash).

    Defined cases: null, empty and wordless texts are copies of one another (fingerprint
    zero); the others are as for one_of_each().
    """
    texts = docs.select(F.xxhash64(text_col).alias("node"), F.col(text_col).alias("text"))
    found = near_duplicates(texts, "node", "text", width, distance)
    roots = found.groupBy(F.col("doc_id").alias("node")).agg(F.min("component_fp").alias("root"))
    return _firsts(docs, roots, id_col, text_col)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op9_simhash": op9_simhash}
