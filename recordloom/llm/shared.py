"""Small helpers that every corpus operator uses: durable intermediate tables and bounded head tables."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where intermediate tables go only if the session names no checkpoint folder and runs in one process (as in tests).
FALLBACK_DIR = "/tmp/recordloom-checkpoints"
#: Rows of a batch that goes to a Python worker; characters of texts that it lays out at once where memory is short.
ROWS, CHARS = 2_000, 500_000


def shared_dir(spark: SparkSession) -> str:
    """A fresh path below the folder that driver and executors share (``spark.checkpoint.dir``)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = FALLBACK_DIR
    return f"{root.rstrip('/')}/recordloom-{uuid.uuid4().hex}"


def as_uri(path: str) -> str:
    return path if ":" in path.split("/")[0] else f"file://{path}"


def make_folder(folder: str) -> None:
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)


def drop_folder(folder: str) -> None:
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    store.delete_dir(root)


def stored(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back.

    This cuts the lineage: a lost executor costs a reread of the files, not of what made them, and values
    that are not deterministic (row ids, range partitions) stay fixed from here on.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete the table behind what ``stored`` returned, once nothing that reads it is still to run."""
    path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path.getParent(), True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` reads, as the optimizer knows them (no pass over the data); 0 for what has no files."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(n for n in sizes if n < 1 << 60)  # rows made by the driver have no size: the largest long


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The text column as Python strings; null counts as the empty text."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def small_batches(spark: SparkSession) -> None:
    """From now on this session sends Python workers at most ``ROWS`` rows at once: a batch of texts lies in the executor's
    direct memory and, twice over, in the worker's."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ROWS:
        spark.conf.set(key, ROWS)


@lru_cache(None)
def _trim():
    """glibc's malloc_trim, where there is one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``; what a batch's work has freed goes back to the system, not to a worker's heap."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()
        _trim()(0)


def slices(batch: pa.RecordBatch, column: str = "text", chars: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``chars`` bytes of text (one longer text makes a run of its own)."""
    import pyarrow.compute as pc

    col = batch.column(batch.schema.get_field_index(column))
    sizes = pc.fill_null(pc.binary_length(col), 0).to_pylist()
    first, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > chars:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += n
    if first < len(sizes):
        yield batch.slice(first)


def threshold_for_head(counts: DataFrame, column: str, most: int) -> int:
    """The smallest count c such that at most ``most`` rows have ``column`` >= c.

    The rows are first summed into one row for each value up to 4096 and each power of two beyond it, so
    only a few thousand rows reach the driver, whatever the size of the table.
    """
    c = F.col(column)
    bucket = F.when(c <= 4096, c).otherwise(F.pow(F.lit(2.0), F.floor(F.log2(c))).cast("long"))
    hist = counts.groupBy(bucket.alias("b")).count().collect()
    total = 0
    least = None
    for b, n in sorted(((r[0], r[1]) for r in hist), reverse=True):
        if total + n > most:
            break
        total += n
        least = b
    return int(least) if least is not None else 1 << 62
