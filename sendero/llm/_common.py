"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BASE = 0x9E3779B97F4A7C15 | 1


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Where the setting is absent a temporary folder serves, which only a local master may use.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = getattr(spark.sparkContext, "_sendero_shared", None)
    if own is None:
        own = spark.sparkContext._sendero_shared = "file://" + tempfile.mkdtemp(prefix="sendero-")
    return own


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most so many rows go to a Python worker at a time in queries that run inside."""
    was = spark.conf.get(BATCH)
    spark.conf.set(BATCH, rows)
    try:
        yield
    finally:
        spark.conf.set(BATCH, was)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for queries that run inside."""
    was = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_scratch: list[list[tuple[str, str]]] = []


@contextmanager
def scratch(spark: SparkSession, keep: set[str]) -> Iterator[None]:
    """Delete what written() writes inside, at the end, but for tables of the names in keep."""
    _scratch.append([])
    try:
        yield
    finally:
        for name, path in _scratch.pop():
            if name not in keep:
                deleted(spark, path)


def deleted(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark can write."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, name: str, batch: int = 1000) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage is cut, lost executors cost nothing.

    batch: rows that go to a Python worker at a time, few where rows are large.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scratch:
        _scratch[-1].append((name, path))
    with arrow_batches(spark, batch):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def freed(df: DataFrame) -> DataFrame:
    """df, after the shuffle files of finished steps have gone; Spark drops them once the driver collects its garbage."""
    gc.collect()
    df.sparkSession._jvm.System.gc()
    return df


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, for mapInArrow, after which the worker, which Spark keeps for other tasks, hands its free memory back."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        trim()

    return task


def trim() -> None:
    """Hand free memory of this process back to the system, where the C library can."""
    _powers[:] = [np.ones(1, U64), np.ones(1, U64)]
    gc.collect()
    pa.default_memory_pool().release_unused()
    if give := getattr(ctypes.CDLL(None), "malloc_trim", None):
        give(0)


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int = 64, limit_mb: int = 64) -> DataFrame:
    """Hint a broadcast only when rows * row_bytes, both known beforehand, stay under limit_mb."""
    return F.broadcast(df) if rows * row_bytes <= limit_mb << 20 else df


def keyed(rows: DataFrame, key: str) -> DataFrame:
    """rows with a number of each, the same whenever it is read: its file's, and its place in there.

    Rows that no file holds are written first.
    """
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at")]
    try:
        placed = rows.select("*", *place)
    except AnalysisException:  # not read from files
        placed = (rows := written(rows, "rows")).select("*", *place)
    files = sorted(r[0] for r in placed.select("_file").distinct().collect())  # one row a file
    numbers = rows.sparkSession.createDataFrame(pa.table({"_file": pa.array(files, pa.string()), "_number": pa.array(range(len(files)), pa.int64())}))
    return placed.join(broadcast_if_small(numbers, len(files), 256), "_file").select(*rows.columns, (F.col("_number") * (1 << 36) + F.col("_at")).alias(key))


def spread_join(left: DataFrame, right: DataFrame, on: list[str], by: str, rows: int | None, salts: int = 64, row_bytes: int = 64) -> DataFrame:
    """left joined with right, which has one row for each key, though a key may hold a large share of left.

    right is broadcast if its counted rows are small; else, and if they are of no known size (None), both sides are dealt by the key and a salt, a hash of left's
    column `by`, and right's rows are repeated for each salt that occurs.
    """
    if rows is not None and rows * row_bytes <= 64 << 20:
        return left.join(F.broadcast(right), on)
    left = left.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)))
    occurs = left.groupBy(*on, "_salt").agg(F.count("*").alias("_n")).groupBy(*on).agg(F.collect_list("_salt").alias("_salts"))
    return left.join(right.join(occurs, on).withColumn("_salt", F.explode("_salts")).drop("_salts"), [*on, "_salt"]).drop("_salt")


def digest(text: str = "text") -> F.Column:
    """SHA-256 of the UTF-8 bytes as 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes and the n+1 offsets of an Arrow string or binary column, nulls as empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def pieces(offsets: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of at most about `size` bytes; a longer text stands alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


_powers = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            made = np.full(size, base, U64)
            made[0] = 1
            np.multiply.accumulate(made, out=made)
            _powers[k] = made
    return _powers[0][:n], _powers[1][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """S with S[e] - S[s] = sum of (byte + 1) * B**i over s <= i < e, modulo 2**64."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * powers(len(data))[0], out=out[1:])
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end)."""
    return mixed((sums[end] - sums[start]) * powers(len(sums))[1][start])


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, block: int = 8, most: int = 64) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end): eight bytes at a time, mixed after each; long spans by BLAKE2b."""
    padded = np.concatenate((data, np.zeros(block, np.uint8)))
    at = np.ndarray((len(data) + 1,), "<u8", padded.tobytes(), 0, (1,))
    size = end - start
    out = mixed(size.astype(U64) + U64(_BASE))
    own, left = np.arange(len(start)), size
    for k in range(0, most, block):
        bits = np.minimum(left, block).astype(U64) * U64(8)
        part = at[start[own] + k] & (~U64(0) >> (U64(64) - bits))
        out[own] = mixed((out[own] ^ part) * U64(0xD6E8FEB86659FD93) + U64(k))
        keep = left > block
        own, left = own[keep], left[keep] - block
        if not len(own):
            return out
    raw = data.tobytes() if len(own) else b""
    for i in own.tolist():
        out[i] = int.from_bytes(hashlib.blake2b(raw[start[i] : end[i]], digest_size=8).digest(), "little")
    return out


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends of the words of several texts laid end to end, and the first word's index of each text (n+1).

    is_word: which of the 256 bytes belong to words; words never cross texts.
    """
    mask = np.zeros(len(data) + 1, bool)
    mask[:-1] = is_word[data]
    edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if len(data) and mask[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]
    cuts = offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(data))])
    cuts = cuts[mask[cuts] & mask[cuts - 1]]
    if len(cuts):
        start, end = np.sort(np.concatenate((start, cuts))), np.sort(np.concatenate((end, cuts)))
    return start, end, np.searchsorted(start, offsets)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, every other byte as it is."""
    return _LOWER[data]


ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False


def shingles(word_hash: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k consecutive words (none if there are fewer)."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for i in range(k):
        out *= U64(0xD6E8FEB86659FD93)
        out += word_hash[i : i + n]
    return mixed(out)
