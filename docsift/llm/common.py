"""Shared helpers: Arrow maps over rows, run folders in the shared store, broadcast bounds."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.session import ship

#: Bytes that an operator may broadcast at most; larger sides are joined or worked in blocks.
BROADCAST_BYTES = 64 << 20
#: Bytes of text that a Python step works on at once; one longer text makes a block of its own.
BLOCK_BYTES = 8 << 20
#: Bytes of an Arrow batch that Spark fills for a Python step of a stored table.
BATCH_BYTES = 8 << 20
#: Lower-cases A-Z in UTF-8 bytes and leaves all other bytes.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_own_root: dict[str, str] = {}
_made: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder, spark.checkpoint.dir. Where it is unset: a folder of our own in local mode, an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_root:
        _own_root[app] = "file://" + tempfile.mkdtemp(prefix="docsift-shared-")
    return _own_root[app]


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared store, removed by cleanup()."""
    path = f"{shared_root(spark)}/docsift/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


@contextlib.contextmanager
def small_batches(spark: SparkSession, limit: int = BATCH_BYTES):
    """Bounds the bytes of an Arrow batch in what runs inside, whatever the rows' lengths; the session's own setting comes back after."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(name)
    spark.conf.set(name, str(limit))
    try:
        yield
    finally:
        spark.conf.set(name, own)


def stored(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage and survives lost executors."""
    spark, schema = df.sparkSession, df.schema
    path = run_folder(spark, name)
    writer = df.write if codec is None else df.write.option("compression", codec)
    with small_batches(spark):
        writer.parquet(path)
    return spark.read.schema(schema).parquet(path)


def mark() -> int:
    """How many run folders there are so far, for cleanup()."""
    return len(_made)


def cleanup(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> None:
    """Delete the run folders made since a mark, but for the one that keep is read from. Call it when results that read them are written."""
    kept = {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for f in keep.inputFiles()} if keep is not None else set()
    for path in _made[since:]:
        if path.rsplit("/", 1)[-1] not in kept:
            _delete(spark, path)
            _made.remove(path)


def blocks(texts: Iterable[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows whose texts come to about limit bytes."""
    start = size = 0
    at = -1
    for at, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield start, at + 1
            start, size = at + 1, 0
    if start <= at:
        yield start, at + 1


def trim() -> None:
    """Give memory that a Python worker no longer uses back to the system: workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    ship(df.sparkSession)

    def run(batches):
        yield from function(batches)
        trim()

    return df.mapInArrow(run, schema)


def per_batch(function: Callable[[pa.RecordBatch], pa.RecordBatch | None]):
    """An Arrow map that works batch by batch and skips empty ones."""

    def run(batches):
        for batch in batches:
            if batch.num_rows and (out := function(batch)) is not None:
                yield out

    return run


def encoded(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def crc_mod(column: Column, modulus: int) -> Column:
    """crc32 of an id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(column.cast("string"), F.lit("")), "UTF-8")) % modulus


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of frames that are no longer used: its cleaner acts when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(table: DataFrame) -> None:
    """Delete a stored table that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        _delete(table.sparkSession, folder)


def free_name(df: DataFrame, name: str) -> str:
    """name, or name with a number, that df has no column of (in any case)."""
    taken, k = {c.lower() for c in df.columns}, 0
    while (found := f"{name}_{k}" if k else name).lower() in taken:
        k += 1
    return found
