"""What the operators share: scratch tables, size-checked joins, Arrow batches."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only if it was measured to need at most this; where the other side is whole texts, which would
#: have to be shuffled instead, at most BESIDE_TEXTS.
BROADCAST_BYTES, BESIDE_TEXTS, ITEM_BYTES = 8 << 20, 64 << 20, 64


def tune(spark: SparkSession) -> None:
    """Bounds what one Arrow batch holds, so that a Python worker's memory doesn't follow the texts' lengths."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 20))


def lean(run, keeps_words: bool = False):
    """run, a function for mapInArrow, that gives the task's free memory back at its end: workers live on, and what their
    allocators keep adds up beside the executor's heap. Cached token ids stay only after tasks that use them (keeps_words)."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes
            import gc
            import sys

            import pyarrow as pa

            if not keeps_words and (tokens := sys.modules.get(f"{__package__}.tokens")):
                tokens.forget()
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):
                pass  # another C library

    return wrapped


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); one of its own only where that is
    unset and everything runs on one machine, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='changelake-')}"
        atexit.register(shutil.rmtree, found.removeprefix("file://"), ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = path or scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Deletes a scratch table through Spark's own file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def sized(side: DataFrame, row_bytes: int, *varying: str, most: int | None = None) -> DataFrame:
    """side, with a broadcast hint if it is measured to stay under BROADCAST_BYTES (or `most`) in a task's hash table; otherwise as it is,
    for a shuffled join. row_bytes: the fixed-width columns of a row; varying: columns whose sizes are summed up, binary ones,
    arrays (of at most ITEM_BYTES an item), or numbers that say how many bytes others hold."""
    size, kinds = F.lit(2 * row_bytes + 48).cast("long"), dict(side.dtypes)
    for name in varying:
        own = F.size(name) * ITEM_BYTES if kinds[name].startswith("array") else F.octet_length(name) if kinds[name] == "binary" else F.col(name)
        size = size + F.coalesce(own, F.lit(0))
    total = side.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return F.broadcast(side) if total <= (most or BROADCAST_BYTES) else side


def rested(spark: SparkSession) -> None:
    """Executors give their free heap back: between the stages of a pipeline a JVM would otherwise keep the most that any stage
    took, beside the Python workers of the next. One short task a core; System.gc() by SQL's reflect."""
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.expr("reflect('java.lang.System', 'gc')").alias("done")).write.format("noop").mode("overwrite").save()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets of n + 1) of an Arrow string or binary column, without copying; null counts as empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.cast(pa.binary()).fill_null(b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(batches, most_bytes: int, text: str = "text"):
    """Record batches regrouped into slices of at most about most_bytes of text (one longer text stays whole)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = utf8(batch.column(batch.schema.get_field_index(text)))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(at, at[start] + most_bytes, "right")) - 1)
            yield batch.slice(start, min(end, batch.num_rows) - start)
            start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A full-avalanche mixer of 64-bit words (multiply-xorshift)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
