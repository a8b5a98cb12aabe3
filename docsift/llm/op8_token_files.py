"""Operator 8: token ids as flat unsigned integer files with 64-bit document offsets.

Format.  A data set is a folder of shards, numbered in ascending doc_id order by
(shard, part).  Each has `<name>.ids` (little-endian unsigned integers, of 16 bits where
the vocabulary's ids fit, else of 32), `<name>.off` (n + 1 unsigned 64-bit offsets within
the file) and `<name>.doc` (n signed 64-bit document ids, nulls first).  The manifest
has a row a file with its integer type; a file's base, the number of ids before it, is
the prefix sum of the files before it, so no file waits for another while it is written.

Work.  One range shuffle by document id; every partition then encodes and appends
in a stream, and begins another file after SHARD_IDS ids, so that files stay of a size
that readers can share.  A file's name holds a fresh token, and only the manifest row of
the task attempt that succeeded names it, so lost executors and repeated tasks do no
harm.  Readers map the files where the store is a mounted folder, and read ranges of
them elsewhere.

Defined cases: null text counts as empty (the end id alone); null doc_id sorts
first; rows that repeat a doc_id are ordered by a hash of the text and all kept; a very
long text is one document of its file; an empty table gives no file; extra columns are
ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm import bpe, files
from docsift.llm.common import blocks, map_arrow, run_folder, stored, table

MANIFEST = "shard int, part int, name string, n_docs long, n_null long, n_ids long, dtype string"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"
#: Ids after which a task begins another file.
SHARD_IDS = 1 << 27
_KINDS = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())


class _Shard:
    """The three files of one shard, appended to in a stream."""

    def __init__(self, folder: str, number: int, part: int, dtype: str):
        self.number, self.part, self.dtype = number, part, dtype
        self.name = f"{number:06d}-{part:04d}-{uuid.uuid4().hex}"
        self.outs = {kind: files.create(f"{folder}/{self.name}.{kind}") for kind in ("ids", "off", "doc")}
        self.outs["off"].write(np.zeros(1, "<u8").tobytes())
        self.docs = self.nulls = self.total = 0

    def add(self, ids: pa.Array, tokens: np.ndarray, ends: np.ndarray) -> None:
        self.outs["doc"].write(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
        self.outs["ids"].write(tokens.astype(self.dtype).tobytes())
        self.outs["off"].write((ends[1:] + self.total).astype("<u8").tobytes())
        self.docs, self.nulls, self.total = self.docs + len(ids), self.nulls + ids.null_count, self.total + len(tokens)

    def close(self) -> pa.RecordBatch:
        for out in self.outs.values():
            out.close()
        values = (self.number, self.part, self.name, self.docs, self.nulls, self.total, self.dtype)
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _KINDS)], names=["shard", "part", "name", "n_docs", "n_null", "n_ids", "dtype"])


def _writer(folder: str, vocabulary: str, dtype: str, end_id: int, shard_ids: int):
    def run(batches):
        shard, part = None, 0
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            for lo, hi in blocks(texts, bpe.BLOCK_BYTES):
                if shard is None:
                    shard = _Shard(folder, TaskContext.get().partitionId(), part, dtype)
                shard.add(batch.column(0).slice(lo, hi - lo), *bpe.encoder(vocabulary).encode(texts[lo:hi], end_id))
                if shard.total >= shard_ids:
                    yield shard.close()
                    shard, part = None, part + 1
        if shard is not None:
            yield shard.close()

    return run


def write_token_files(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None, end_id: int = 0, dtype: str | None = None, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS) -> tuple[str, DataFrame]:
    """Write the files; returns their folder and the manifest, one row a file. dtype: "<u2" or "<u4" (None: the least that holds the vocabulary)."""
    spark, vocabulary = docs.sparkSession, vocabulary or bpe.default_path()
    least = bpe.id_type(vocabulary, end_id)
    if dtype == "<u2" and least != dtype:
        raise ValueError("the vocabulary has ids beyond 16 bits")
    folder = folder or run_folder(spark, "token-files")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionByRange(shards, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    manifest = map_arrow(dealt, _writer(folder, vocabulary, dtype or least, end_id, shard_ids), MANIFEST)
    return folder, stored(manifest, "token-manifest")


def _reader(folder: str):
    def run(batches):
        for batch in batches:
            for shard in batch.to_pylist():
                at = f"{folder}/{shard['name']}"
                ids, off, doc = files.Ranges(f"{at}.ids", shard["dtype"]), files.Ranges(f"{at}.off", "<u8"), files.Ranges(f"{at}.doc", "<i8")
                for lo in range(0, shard["n_docs"], 4096):
                    hi = min(lo + 4096, shard["n_docs"])
                    ends = off[lo : hi + 1].astype(np.int64)
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc[lo:hi], pa.int64(), mask=np.arange(lo, hi) < shard["n_null"]), pa.array(ends[:-1] + shard["base"]), pa.array(np.diff(ends)), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return run


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """A row per stored document, from the files; the manifest (a row a file of up to SHARD_IDS ids) is what the driver gathers."""
    rows, base = [], 0
    for shard in sorted(manifest.collect(), key=lambda r: (r["shard"], r["part"])):
        rows.append((shard["name"], shard["n_docs"], shard["n_null"], shard["dtype"], base))
        base += shard["n_ids"]
    dealt = spark.createDataFrame(rows, "name string, n_docs long, n_null long, dtype string, base long").repartition(max(1, len(rows)))
    return map_arrow(dealt, _reader(folder), DOCS)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = write_token_files(table(spark, sf_dir, "documents"))
    return read_token_files(spark, folder, manifest)


QUERIES = {"op8_token_files": op8_token_files}
