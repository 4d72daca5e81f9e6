"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a temporary folder for a local master only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = getattr(spark.sparkContext, "_sendero_stage", None)
    if own is None:
        own = spark.sparkContext._sendero_stage = "file://" + tempfile.mkdtemp(prefix="sendero-")
    return own


_open: list[list[str]] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end, when whatever is to last has been written elsewhere."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet and read back: what is dear is done once, plans stay small, lost executors cost nothing."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int = 256, limit_mb: int = 64) -> DataFrame:
    """df with a hint to broadcast it, only if its counted rows stay under limit_mb; else it is joined by a shuffle."""
    return F.broadcast(df) if rows * row_bytes <= limit_mb << 20 else df
