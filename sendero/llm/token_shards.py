"""Training-order materialisation of token sequences.

Texts are encoded once, each followed by the end token, cut into sequences of `length` ids and written, compressed, to a
table; what a partition's last sequence lacks is filled with end tokens. Sequences are numbered 0..N-1 by partition and
place. A keyed Feistel network over the least even number of bits that hold N, walked along its cycles until it falls
below N, permutes the numbers: slot = P_key(number), a bijection that needs no shuffle buffer and no stored order. Slots
are dealt to partitions by ranges of whole shards, and each shard is a file of `per_shard` sequences of a fixed stride:
slot s starts at byte (s mod per_shard) * stride of file s div per_shard, so reading on from any slot is one seek.

A shard is written under another name and moved, so a file is whole or absent. A run that broke off may be started again in
the same `place`, with the same docs or others: the encoded table that it left is used only if a fingerprint of docs,
tokenizer and parameters agrees, and a shard stays only if it holds, byte for byte, what this run would write; files of
shards that this run does not have are deleted. So the result is always that of a run in an empty place.

Defined cases: null and empty texts give an end token alone; null or repeated ids are listed as they are; other columns
are ignored; an empty table gives no shard.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sendero.llm import bpe
from sendero.llm._common import U64, arrow_batches, deleted, lean, mixed, pieces, shared_dir, strings

ROUNDS = 6
IN_RANGE = 8  # shards that one task writes, from memory
INDEX = "shard bigint, file string, first_slot bigint, n int, stride int, docs array<array<bigint>>"


class Feistel:
    """A keyed permutation of 0..n-1."""

    def __init__(self, n: int, key: int) -> None:
        self.n, self.half = n, max(1, -(-max(n - 1, 1).bit_length() // 2))
        self.mask = U64((1 << self.half) - 1)
        self.keys = mixed(np.arange(1, ROUNDS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(key & (1 << 64) - 1))

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> U64(self.half), x & self.mask
        for k in self.keys:
            left, right = right, left ^ (mixed(right ^ k) & self.mask)
        return left << U64(self.half) | right

    def _back(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> U64(self.half), x & self.mask
        for k in self.keys[::-1]:
            left, right = right ^ (mixed(left ^ k) & self.mask), left
        return left << U64(self.half) | right

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        out = step(np.asarray(x, U64))
        while (beyond := np.flatnonzero(out >= U64(self.n))).size:
            out[beyond] = step(out[beyond])
        return out.astype(np.int64)

    def slot(self, number: np.ndarray) -> np.ndarray:
        return self._walk(number, self._once)

    def number(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, self._back)


def _encoded(batches: Iterator[pa.RecordBatch], path: str, end: int) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """Ids with end tokens, the offsets after each text, and the texts' ids."""
    tok = bpe.tokenizer(path)
    for batch in batches:
        data, offsets = strings(batch.column("text"))
        names = batch.column("id")
        for a, b in pieces(offsets, bpe.PIECE):
            ids, at = tok.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            yield np.insert(ids, at[1:], end), at[1:] + np.arange(1, b - a + 1), names.slice(a, b - a).to_pylist()


SEQUENCES = "part int, first bigint, n int, ids binary, docs array<array<bigint>>"
OWNERS = pa.list_(pa.list_(pa.int64()))


def _packed(ids: np.ndarray) -> bytes:
    return pa.Codec("zstd", compression_level=3).compress(ids.tobytes(), asbytes=True)


def _unpacked(raw: bytes, size: int, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(pa.Codec("zstd").decompress(raw, decompressed_size=size, asbytes=True), kind)


def sequences(rows: DataFrame, file: str, end: int, length: int, kind: np.dtype, chunk: int = 1024) -> DataFrame:
    """The sequences of rows(id, text), up to `chunk` in a row: part, first (number in the part), n, ids, docs of each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, held, owned = TaskContext.get().partitionId(), 0, [], []
        rest, rest_docs = np.zeros(0, kind), []

        def made() -> pa.RecordBatch:
            nonlocal done, held, owned
            n = len(owned)
            batch = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([done], pa.int64()), pa.array([n], pa.int32()), pa.array([_packed(np.concatenate(held))], pa.binary()), pa.array([owned], OWNERS)], names=["part", "first", "n", "ids", "docs"])
            done, held, owned = done + n, [], []
            return batch

        for ids, ends, names in _encoded(batches, file, end):
            ids, ends = np.concatenate((rest, ids.astype(kind))), ends + len(rest)
            m = len(ids) // length
            # Of each sequence, also the last and unfinished one, the texts that own its first and its last id.
            begin = np.searchsorted(ends, np.arange(m + 1) * length, "right")
            last = np.searchsorted(ends, np.arange(1, m + 2) * length - 1, "right")
            owners = [(rest_docs if k == 0 else []) + names[begin[k] : last[k] + 1] for k in range(m + 1)]
            if m:
                held.append(ids[: m * length])
                owned += owners[:m]
                if len(owned) >= chunk:
                    yield made()
            rest, rest_docs = ids[m * length :], owners[m] if len(ids) % length else []
        if len(rest):
            held.append(np.concatenate((rest, np.full(length - len(rest), end, kind))))
            owned.append(rest_docs)
        if owned:
            yield made()

    return rows.mapInArrow(lean(cut), SEQUENCES)


def _files(place: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, and the folder's name in it."""
    return fs.FileSystem.from_uri(place.replace("s3a://", "s3://", 1))


def shard_name(shard: int) -> str:
    return f"shard-{shard:010d}.bin"


def _digest(path: str) -> str:
    """SHA-256 of a tokenizer's file, which the driver reads too."""
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


#: Count and two order-free sums of the rows' hashes, as SQL expressions over id and text.
ROWS_HASH = {"rows": "count(*)", "xor": "bit_xor(xxhash64(id, text))", "sum": "sum(pmod(xxhash64(text, id), 2147483647))"}


def _sequence_table(rows: DataFrame, place: str, store: fs.FileSystem, folder: str, told: dict, file: str, end: int, length: int, kind: np.dtype) -> DataFrame:
    """The encoded table in `place`: that of a run over the same rows and parameters which broke off, else a new one."""
    spark, held, note = rows.sparkSession, f"{place}/sequences", f"{folder}/sequences.json"
    if store.get_file_info(note).type == fs.FileType.File:
        with store.open_input_stream(note) as f:
            known = json.loads(f.read())
        now = {k: str(v) for k, v in rows.selectExpr(*[f"{e} AS {k}" for k, e in ROWS_HASH.items()]).first().asDict().items()}
        if known == told | now:
            return spark.read.schema(SEQUENCES).parquet(held)
        store.delete_file(note)
    seen = Observation()
    with arrow_batches(spark, 1000):
        observed = rows.observe(seen, *[F.expr(e).alias(k) for k, e in ROWS_HASH.items()])
        sequences(observed, file, end, length, kind).write.mode("overwrite").option("compression", "uncompressed").parquet(held)
    with store.open_output_stream(note) as f:  # only now does the table count
        f.write(json.dumps(told | {k: str(v) for k, v in seen.get.items()}).encode())
    return spark.read.schema(SEQUENCES).parquet(held)


def _holds(store: fs.FileSystem, name: str, raw: bytes) -> bool:
    """Whether a file has exactly these bytes."""
    if store.get_file_info(name).size != len(raw):
        return False
    with store.open_input_stream(name) as f:
        return f.read() == raw


def write_shards(docs: DataFrame, length: int = 1024, per_shard: int = 1024, key: int = 20240101, end: int | None = None, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", place: str | None = None) -> tuple[DataFrame, int]:
    """Write all sequences of docs in training order as files in `place`; returns the index of the shards and N.

    Index: shard, file, first_slot, n, stride, docs (the ids of the texts in each sequence).
    """
    spark = docs.sparkSession
    place = place or f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    store, folder = _files(place)
    store.create_dir(folder, recursive=True)
    file = path or bpe.default_path()
    tok = bpe.tokenizer(file)
    end = next(iter(tok.special.values())) if end is None else end
    kind = np.dtype("<u2" if len(tok.lengths) <= 1 << 16 else "<u4")
    stride = length * kind.itemsize
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    told = {"length": str(length), "end": str(end), "tokenizer": _digest(file), "ids": kind.str}
    table = _sequence_table(rows, place, store, folder, told, file, end, length, kind)
    starts, n = {}, 0
    for r in table.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():  # one row a partition
        starts[r.part] = n
        n += r.n
    order = Feistel(n, key)
    shards = -(-n // per_shard)
    ranges = max(1, -(-shards // IN_RANGE))
    files = [info for info in store.get_file_info(fs.FileSelector(folder)) if info.base_name.endswith(".bin") or info.base_name.startswith(".shard-")]
    there = {info.base_name for info in files}
    for info in files:  # drafts, and shards beyond the last
        if info.base_name.startswith(".") or not info.base_name[6:-4].isdigit() or int(info.base_name[6:-4]) >= shards:
            store.delete_file(info.path)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, m, ids, owners in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                slot = order.slot(starts[part] + first + np.arange(m))
                ids = _unpacked(ids, m * stride, kind).reshape(m, length)
                by = np.argsort(slot)
                own = slot[by] // per_shard // IN_RANGE
                cuts = [*np.flatnonzero(np.diff(own, prepend=-1)).tolist(), m]
                made = [(int(own[i]), slot[by[i:j]].tobytes(), _packed(ids[by[i:j]]), [owners[k] for k in by[i:j].tolist()]) for i, j in itertools.pairwise(cuts)]
                for i in range(0, len(made), 64):
                    to, slots, raw, listed = zip(*made[i : i + 64], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(slots, pa.binary()), pa.array(raw, pa.binary()), pa.array(listed, OWNERS)], names=["range", "slots", "ids", "docs"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ids, owners, store, folder = None, None, [], *_files(place)
        for batch in batches:
            for to, slots, raw, listed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own is None:
                    own, base = to, to * IN_RANGE * per_shard
                    ids = np.zeros((min(n - base, IN_RANGE * per_shard), length), kind)
                    owners = [None] * len(ids)
                if to != own:
                    raise ValueError("two ranges of shards in one partition")
                at = np.frombuffer(slots, np.int64) - base
                ids[at] = _unpacked(raw, len(at) * stride, kind).reshape(-1, length)
                for i, docs_of in zip(at.tolist(), listed, strict=True):
                    owners[i] = docs_of
        for i in range(0, len(owners), per_shard):
            shard, some = (base + i) // per_shard, ids[i : i + per_shard]
            if any(x is None for x in owners[i : i + per_shard]):
                raise ValueError(f"shard {shard} lacks a sequence")
            raw, name = some.tobytes(), f"{folder}/{shard_name(shard)}"
            if shard_name(shard) not in there or not _holds(store, name, raw):
                draft = f"{folder}/.{shard_name(shard)}-{uuid.uuid4().hex}"
                with store.open_output_stream(draft) as out:
                    out.write(raw)
                store.move(draft, name)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([f"{place}/{shard_name(shard)}"]), pa.array([base + i], pa.int64()), pa.array([len(some)], pa.int32()), pa.array([stride], pa.int32()), pa.array([owners[i : i + per_shard]], OWNERS)], names=["shard", "file", "first_slot", "n", "stride", "docs"])

    dealt = table.mapInArrow(lean(deal), "range int, slots binary, ids binary, docs array<array<bigint>>")
    with arrow_batches(spark, 16):
        dealt.repartitionById(ranges, "range").mapInArrow(lean(write), INDEX).write.mode("overwrite").parquet(f"{place}/index")
    store.delete_file(f"{folder}/sequences.json")
    deleted(spark, f"{place}/sequences")
    return spark.read.schema(INDEX).parquet(f"{place}/index"), n


def read_slots(shards: DataFrame, start: int = 0, stop: int | None = None, block: int = 256) -> DataFrame:
    """Sequences of slots [start, stop): slot, shard, offset (byte in the shard's file), ids (bytes), docs."""
    if start:
        shards = shards.filter(F.col("first_slot") + F.col("n") > start)
    if stop is not None:
        shards = shards.filter(F.col("first_slot") < stop)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lo, hi = max(0, start - row["first_slot"]), row["n"] if stop is None else min(row["n"], stop - row["first_slot"])
                stride, (store, name) = row["stride"], _files(row["file"])
                with store.open_input_file(name) as file:
                    file.seek(lo * stride)
                    for i in range(lo, hi, block):
                        j = min(hi, i + block)
                        raw = file.read((j - i) * stride)
                        if len(raw) != (j - i) * stride:
                            raise ValueError(f"{row['file']} is too short")
                        yield pa.RecordBatch.from_arrays([pa.array(range(row["first_slot"] + i, row["first_slot"] + j), pa.int64()), pa.array([row["shard"]] * (j - i), pa.int64()), pa.array(range(i * stride, j * stride, stride), pa.int64()), pa.array([raw[k : k + stride] for k in range(0, len(raw), stride)], pa.binary()), pa.array(row["docs"][i:j], pa.list_(pa.int64()))], names=["slot", "shard", "offset", "ids", "docs"])

    return shards.mapInArrow(lean(split), "slot bigint, shard bigint, offset bigint, ids binary, docs array<bigint>")


def ids_of(blob: bytes, stride: int, length: int = 1024) -> np.ndarray:
    """A shard's ids, a row for each sequence."""
    return np.frombuffer(blob, np.dtype(f"<u{stride // length}")).reshape(-1, length)


def hashed(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def op2_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence of documents in training order, as read back from the shards."""
    shards, _ = write_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return read_slots(shards).select("slot", "shard", "offset", F.octet_length("ids").cast("bigint").alias("n_bytes"), F.sha2("ids", 256).alias("ids_sha256"), F.col("docs").alias("doc_ids"))
