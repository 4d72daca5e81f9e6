"""Exact dedup by a log-structured merge index of text digests.

A task collects (digest, id) in a memtable. A full memtable is flushed as a sorted run with a Bloom filter, a digest
once with its extreme id and count. Every FANIN runs of a level are merged into one run of the next; a run that has
grown to SHIPPED entries, and what is left at a task's end, is cut by ranges of digests. Compaction reads the runs of a
range and merges them by levels in the same way. In a merge, an entry that no other run's filter knows is unique there
and is only put in its place; the others are compared, keeping the extreme id. An entry takes part in as many merges
as there are levels, so work grows as the entries times the logarithm of the runs.

Rows whose digest is a hit are then compared byte by byte with the row that stays, large groups in parts of PART rows
that each get that row's text; rows that share a digest and no bytes are taken apart and grouped again, so that even a
weak digest gives exact groups.

Defined cases: a null text counts as empty; a null id never wins over another id; rows that repeat id and text count
each in the group's size and share their fate; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sendero.llm._common import broadcast_if_small, digest, lean, strings, written

RUN = "bucket int, digests binary, ids binary, counts binary, filter binary"
FANIN, SHIPPED, PART = 8, 400_000, 512
Run = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # digests (n rows of four words, in order), ids, counts, filter
NO_ID = {"largest": -(1 << 63), "smallest": (1 << 63) - 1}


def _bits(n: int) -> int:
    return 1 << max(6, int(n * 16 - 1).bit_length())


def bloom(keys: np.ndarray) -> np.ndarray:
    """A Bloom filter of digests (rows of four 64-bit words), 16 or more bits and two probes an entry."""
    size = _bits(len(keys))
    bits = np.zeros(size, bool)
    bits[(keys[:, 0] & np.uint64(size - 1)).astype(np.int64)] = True
    bits[(keys[:, 1] & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits)


def in_bloom(packed: np.ndarray, keys: np.ndarray) -> np.ndarray:
    size = len(packed) * 8
    probe = lambda k: (packed[(k >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (k & np.uint64(7)).astype(np.uint8))) & 1
    return (probe(keys[:, 0] & np.uint64(size - 1)) & probe(keys[:, 1] & np.uint64(size - 1))).astype(bool)


def _reduced(keys: np.ndarray, ids: np.ndarray, counts: np.ndarray, keep: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """In order, each digest once with its extreme id and the sum of its counts."""
    if not len(keys):
        return keys, ids, counts
    order = np.lexsort(keys.T[::-1])
    keys, ids, counts = keys[order], ids[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
    return keys[first], (np.maximum if keep == "largest" else np.minimum).reduceat(ids, first), np.add.reduceat(counts, first)


def flushed(keys: np.ndarray, ids: np.ndarray, keep: str) -> Run:
    """A memtable's rows as a run."""
    keys, ids, counts = _reduced(keys, ids, np.ones(len(ids), np.int64), keep)
    return keys, ids, counts, bloom(keys)


def merge_runs(runs: list[Run], keep: str) -> Run:
    """One run of several. What no other run's filter knows is unique here and is compared with nothing."""
    if len(runs) == 1:
        return runs[0]
    alone, shared = [], []
    for i, (keys, ids, counts, _) in enumerate(runs):
        some = np.zeros(len(keys), bool)
        for j, other in enumerate(runs):
            if j != i:
                rest = np.flatnonzero(~some)
                some[rest] = in_bloom(other[3], keys[rest])
        alone.append((keys[~some], ids[~some], counts[~some]))
        shared.append((keys[some], ids[some], counts[some]))
    merged = _reduced(*(np.concatenate(x) for x in zip(*shared, strict=True)), keep)
    keys, ids, counts = (np.concatenate(x) for x in zip(*alone, merged, strict=True))
    order = np.argsort(keys[:, 0], kind="stable")
    if len(order) > 1 and (keys[order[1:], 0] == keys[order[:-1], 0]).any():  # first words seldom tell too little
        order = np.lexsort(keys.T[::-1])
    keys = keys[order]
    return keys, ids[order], counts[order], bloom(keys)


class Levels:
    """Runs by level; FANIN runs of one level become one of the next."""

    def __init__(self, keep: str) -> None:
        self.keep, self.levels = keep, [[]]

    def add(self, run: Run) -> None:
        self.levels[0].append(run)
        for k, level in enumerate(self.levels):
            if len(level) < FANIN:
                return
            if k + 1 == len(self.levels):
                self.levels.append([])
            self.levels[k + 1].append(merge_runs(level, self.keep))
            level.clear()

    def grown(self, least: int) -> Iterator[Run]:
        """The runs of at least so many entries, which leave."""
        for level in self.levels:
            yield from (run for run in level if len(run[1]) >= least)
            level[:] = [run for run in level if len(run[1]) < least]

    def merged(self) -> list[Run]:
        """All that is left as one run, or none."""
        held = [run for level in self.levels for run in level]
        while len(held) > 1:
            held = [merge_runs(held[i : i + FANIN], self.keep) for i in range(0, len(held), FANIN)]
        self.levels = [[]]
        return held


def _cut(run: Run, buckets: int) -> pa.RecordBatch:
    """The parts of a run, one for each bucket (a range of digests), each with its filter."""
    keys, ids, counts, _ = run
    bucket = (keys[:, 0] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    own, start = np.unique(bucket, return_index=True)
    ends = [*start[1:].tolist(), len(bucket)]
    cols = list(zip(*((b, keys[s:e].tobytes(), ids[s:e].tobytes(), counts[s:e].tobytes(), bloom(keys[s:e]).tobytes()) for b, s, e in zip(own.tolist(), start.tolist(), ends, strict=True)), strict=True)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=["bucket", "digests", "ids", "counts", "filter"])


def index_hits(keyed: DataFrame, keep: str, buckets: int, memtable: int = 50_000) -> DataFrame:
    """Build and compact the index of keyed(id, digest); the digests of more than one row: digest, keep_id, n."""
    none = NO_ID[keep]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, table, size = Levels(keep), [], 0
        for batch in batches:
            data, offsets = strings(batch.column("digest"))
            table.append((data[offsets[0] : offsets[-1]].view(">u8").astype(np.uint64).reshape(-1, 4), batch.column("id").fill_null(none).to_numpy()))
            size += len(batch)
            if size >= memtable:
                levels.add(flushed(*(np.concatenate(x) for x in zip(*table, strict=True)), keep))
                table, size = [], 0
                for run in levels.grown(SHIPPED):
                    yield _cut(run, buckets)
        if size:
            levels.add(flushed(*(np.concatenate(x) for x in zip(*table, strict=True)), keep))
        for run in levels.merged():
            yield _cut(run, buckets)

    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, levels = None, Levels(keep)

        def ended() -> Iterator[pa.RecordBatch]:
            for keys, ids, counts, _ in levels.merged():
                hit = counts > 1
                raw = keys[hit].astype(">u8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([raw[i : i + 32] for i in range(0, len(raw), 32)], pa.binary()), pa.array(ids[hit], pa.int64()), pa.array(counts[hit], pa.int64())], names=["digest", "keep_id", "n"])

        for batch in batches:
            for bucket, digests, ids, counts, bits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != at:
                    yield from ended()
                at = bucket
                levels.add((np.frombuffer(digests, np.uint64).reshape(-1, 4), np.frombuffer(ids, np.int64), np.frombuffer(counts, np.int64), np.frombuffer(bits, np.uint8)))
        yield from ended()

    runs = keyed.select("id", "digest").mapInArrow(lean(fill), RUN)
    hits = runs.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(lean(compact), "digest binary, keep_id bigint, n bigint")
    return hits.withColumn("keep_id", F.when(F.col("keep_id") != none, F.col("keep_id")))


def exact_dedup(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text", key: Column | None = None) -> DataFrame:
    """One row for each row of docs: id, digest, keep_id, group_size, kept.

    key: a binary column of 32 bytes that equal texts share, SHA-256 unless given.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text.alias("text"), (digest(text_col) if key is None else key).alias("digest"))
    keyed = written(rows.select("id", "digest"), "digests")
    total = keyed.count()
    hits = written(index_hits(keyed, keep, max(8, total // 500_000)), "hits", 10_000)
    n = hits.count()
    extreme = F.max if keep == "largest" else F.min

    def apart(candidates: DataFrame, hits: DataFrame) -> tuple[DataFrame, DataFrame]:
        """candidates(id, digest, text, keep_id) split by whether they equal the row that stays."""
        parts = F.floor(F.col("n") / PART).cast("bigint")
        stay = candidates.filter(F.col("id").eqNullSafe(F.col("keep_id"))).groupBy("digest").agg(F.max("text").alias("stays"), F.max(parts).alias("parts"))
        stay = stay.select("digest", "stays", F.explode(F.sequence(F.lit(0).cast("bigint"), "parts")).alias("part"))
        both = candidates.withColumn("part", F.pmod(F.monotonically_increasing_id(), parts + 1)).join(stay, ["digest", "part"]).drop("part")
        return both.filter(F.col("text") == F.col("stays")).drop("stays"), both.filter(F.col("text") != F.col("stays")).drop("stays")

    candidates = rows.join(broadcast_if_small(hits, n), "digest")
    differ = written(apart(candidates, hits)[1], "differ")
    own = F.col("id")
    if differ.isEmpty():
        found = keyed.join(broadcast_if_small(hits, n), "digest", "left")
        keep_id = F.when(F.col("n").isNull(), own).otherwise(F.col("keep_id"))
        return found.select("id", "digest", keep_id.alias("keep_id"), F.coalesce("n", F.lit(1)).alias("group_size"), own.eqNullSafe(keep_id).alias("kept"))
    # Rows of one digest and different bytes: group the rest again until every row equals the one that stays.
    parts, rest = [written(apart(candidates, hits)[0], "same")], differ
    while not rest.isEmpty():
        rest = rest.drop("keep_id", "n")
        again = rest.groupBy("digest").agg(extreme("id").alias("keep_id"), F.count("*").alias("n"))
        same, other = apart(rest.join(again, "digest"), again)
        parts.append(written(same, "same"))
        rest = written(other, "differ")
    single = keyed.join(hits, "digest", "left_anti").select("id", "digest", own.alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"))
    out = single
    for part in parts:
        part = part.select("id", "digest", "keep_id")
        sizes = part.groupBy("digest").agg(F.count("*").alias("group_size"))
        out = out.unionByName(part.join(sizes, "digest").select("id", "digest", "keep_id", "group_size"))
    return out.withColumn("kept", own.eqNullSafe(F.col("keep_id")))


def op7_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Every row of documents with its group of equal texts; the largest doc_id of a group stays."""
    found = exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep="largest")
    return found.select(F.col("id").alias("doc_id"), "keep_id", F.col("group_size").cast("bigint").alias("group_size"), "kept", F.lower(F.hex("digest")).alias("text_sha256"))


SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
