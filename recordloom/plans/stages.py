"""Stages written to the shared folder: a stage that is complete is read, not made again."""

from __future__ import annotations

import gc
import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FALLBACK_DIR = "/tmp/recordloom-checkpoints"
#: Tables that this process has written, oldest first.
_WRITTEN: list[str] = []


def work_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a folder of this machine only where driver and executors are one process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = FALLBACK_DIR
    return root.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to a fresh table of the shared folder and read back: the lineage ends there."""
    path = f"{work_dir(df.sparkSession)}/linkage-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written() -> int:
    """How many tables of ``stored`` are there now; for ``drop_since``."""
    return len(_WRITTEN)


def drop_since(spark: SparkSession, mark: int = 0, keep: int = 0) -> None:
    """Delete the tables written after ``mark``, but for the last ``keep``: what was made from them must have been used or written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    last = len(_WRITTEN) - keep
    for path in _WRITTEN[mark:last]:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    del _WRITTEN[mark:last]


def only(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """``make()`` written; the tables written on the way are deleted, and shuffle files that nothing refers to any more go with a collection of the driver's garbage."""
    mark = written()
    out = stored(make())
    drop_since(spark, mark, keep=1)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


def signature(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:16]


def stage(spark: SparkSession, name: str, parts: list, make: Callable[[], DataFrame]) -> DataFrame:
    """The table of stage ``name`` for these settings; made anew if it is absent or was not finished (no _SUCCESS)."""
    path = f"{work_dir(spark)}/stage-{name}-{signature(name, parts)}"
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
