"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Two documents link when den * |A and B| >= num * |A or B| over their sets of distinct word shingles. Shingles are put in
one global order, rare before frequent, by counts over the whole corpus. Of a document with n shingles, of which any
link must share a = ceil(num * n / den), the first n - a + l are its l-prefix: linked documents share at least
min(l, l') shingles of their l- and l'-prefixes. Each document lengthens its prefix, choosing the l that makes the
estimated cost least: postings to read plus candidates to verify, which fall as l grows.

1. `classes`: documents with the same set form a class; only classes are compared.
2. `frequent`: counts of all shingles, in sorted runs for ranges of hashes. The most frequent, `known` at most, give the
   order; any order gives right results, so a bounded table bounds what is broadcast and never the result.
3. `postings`: prefix shingles are grouped by ranges of hashes; only shingles of two or more classes go on.
4. Each posting list's most central member (that with the shingle foremost in its order) is a candidate for the others;
   each member is verified against two such centres: large groups of near copies fall into one component without
   their pairs.
5. Of the lists that still hold several components, those of at most `SMALL` members give pairs: members outside a
   list's largest component are matched with all others by length, position and number of shared prefix shingles.
6. Larger lists, by their members' 1-prefixes, are re-centred: lists that share a member of many lists form a group, c is the member next to what most
   of its members hold, and every other member i is replaced by D_i, the shingles in which it differs from c. With
   d = |D|, i and j differ in d_i + d_j - 2 |D_i and D_j| shingles, so two members link if both are near c (then c links
   them), or else only if they share a part of their deviations that grows with d_i and d_j. What all copies have in
   common is gone from the deviations, and prefixes of these, rare in the group before frequent in the group, meet in
   short lists. See `deviation_prefixes` for the bounds. Members that meet are compared by sketches of 512 parities, which
   differ in no more bits than the sets do in shingles, and only pairs that these let through are verified.

No pair is dropped: every pair of two components that the prefixes allow is verified, over whole sets. Components come
from alternating large and small stars on written tables.

Words are hashed to 64 bits block by block with a mixing step after each, longer ones than 64 bytes by BLAKE2b; shingles
are 64-bit mixtures of these. Two different shingles of a pair of documents agree by chance once in 10^13 such pairs.

Defined cases: texts without words (null, empty, white space) have no shingle and link with nothing; a text of fewer
words than a shingle is one shingle; rows without id link with nothing and have no component; rows that repeat an id
count as one document if their texts are equal, and as two that share a name if not; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sendero.llm._common import NOT_SPACE, U64, broadcast_if_small, freed, lean, lowered, mixed, pieces, scratch, shingles, strings, word_hashes, words, written

LONGEST = 8
VERIFY = 10.0  # cost of a verification against that of reading a posting
SMALL = 64  # members of a list that are matched pair by pair
SALTS = 16  # parts of a large group that meet its centre's set apart


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int, is_word: np.ndarray = NOT_SPACE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each of several texts laid end to end."""
    low = lowered(data)
    start, end, first = words(low, offsets, is_word)
    own = word_hashes(low, start, end)
    grams = shingles(own, k)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            found = np.sort(grams[a : b - k + 1])
            yield found[np.concatenate(([True], found[1:] != found[:-1]))]
        else:
            yield shingles(own[a:b], b - a) ^ mixed(np.full(1, b - a, U64)) if b > a else grams[:0]


def class_key(found: np.ndarray, seed: int) -> tuple[int, int]:
    """Two 64-bit hashes of a set."""
    one = int(mixed(found ^ U64(2 * seed + 1)).sum(dtype=U64)) & (1 << 64) - 1
    two = int(mixed(found + U64(0x9E3779B97F4A7C15)).sum(dtype=U64)) & (1 << 64) - 1
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return signed(one), signed(two)


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    data, offsets = strings(batch.column("text"))
    for a, b in pieces(offsets, 1 << 19):
        yield from enumerate(shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], k), a)


def _documents(rows: DataFrame, k: int, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(len(s), *class_key(s, seed)) for _, s in _sets(batch, k)]
            n, one, two = zip(*made, strict=True) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64())], names=["id", "n", "key", "key2"])

    return rows.mapInArrow(lean(run), "id bigint, n bigint, key bigint, key2 bigint")


def _by_range(of: np.ndarray, ranges: int, *columns: np.ndarray) -> Iterator[tuple]:
    """(range, bytes of each column) of rows dealt by their hash's upper half."""
    own = ((of >> U64(32)) * U64(ranges) >> U64(32)).astype(np.int64)
    order = np.argsort(own, kind="stable")
    cuts = np.searchsorted(own[order], np.arange(ranges + 1))
    columns = [c[order] for c in columns]
    for r in np.flatnonzero(np.diff(cuts)).tolist():
        yield r, *(c[cuts[r] : cuts[r + 1]].tobytes() for c in columns)


def _distinct_sets(batches: Iterator[pa.RecordBatch], k: int, seed: int, remember: int = 50_000) -> Iterator[tuple[int, np.ndarray]]:
    """(key, set) of the rows with an id and a shingle, without the copies that this task still remembers."""
    seen: set[int] = set()
    for batch in batches:
        named = batch.column("id").is_valid().to_pylist()
        for i, found in _sets(batch, k):
            if len(found) and named[i]:
                key = class_key(found, seed)[0]
                if key not in seen:
                    if len(seen) >= remember:
                        seen.clear()
                    seen.add(key)
                    yield key, found


def packed(keys: bytes) -> bytes:
    """Sorted 32-bit keys as differences, byte plane by byte plane, of which the upper two are mostly zeros."""
    gaps = np.diff(np.frombuffer(keys, np.uint32), prepend=np.uint32(0))
    return gaps.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    gaps = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
    return np.cumsum(gaps, dtype=np.uint32)


def frequent(rows: DataFrame, k: int, seed: int, ranges: int, known: int, flush: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Upper halves of the most frequent shingle hashes, sorted, and the whole log2 of their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flushed() -> pa.RecordBatch:
            keys, counts = np.unique((np.concatenate(held) >> U64(32)).astype(np.uint32), return_counts=True)
            made = list(_by_range(keys.astype(U64) << U64(32), ranges, keys, counts.astype(np.uint32)))
            return pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.int32()), pa.array([packed(m[1]) for m in made], pa.binary()), pa.array([m[2] for m in made], pa.binary())], names=["range", "keys", "counts"])

        for _, found in _distinct_sets(batches, k, seed):
            held.append(found)
            size += len(found)
            if size >= flush:
                yield flushed()
                held, size = [], 0
        if held:
            yield flushed()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in _grouped(batches, (unpacked, np.uint32)):
            keys, counts = parts
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            level = np.log2(np.add.reduceat(counts.astype(np.int64), first)).astype(np.int64)
            keys = keys[first]
            for at in np.unique(level[level >= 2]).tolist():
                own = keys[level == at]
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([len(own)], pa.int64()), pa.array([own.tobytes()], pa.binary())], names=["level", "n", "keys"])

    runs = rows.mapInArrow(lean(count), "range int, keys binary, counts binary").repartition(ranges, "range").sortWithinPartitions("range")
    table = freed(written(runs.mapInArrow(lean(total), "level int, n bigint, keys binary"), "frequent"))
    least, room = 64, known
    for r in table.groupBy("level").agg(F.sum("n").alias("n")).orderBy(F.desc("level")).collect():  # one row a level
        if r.n > room:
            break
        least, room = r.level, room - r.n
    chosen = table.filter(F.col("level") >= least).select("level", "keys").collect()  # at most `known` keys
    keys = np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(r["keys"], np.uint32) for r in chosen)])
    level = np.concatenate([np.zeros(0, np.uint8), *(np.full(len(r["keys"]) // 4, r.level, np.uint8) for r in chosen)])
    order = np.argsort(keys)
    return keys[order], level[order]


def _grouped(batches: Iterator[pa.RecordBatch], kinds: tuple) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The concatenated columns of each range; rows come sorted by range in their first column."""
    at, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != at and held:
                yield at, [np.concatenate(c) for c in zip(*held, strict=True)]
                held = []
            at = row[0]
            held.append([kind(x) if kind is unpacked else np.frombuffer(x, kind) for x, kind in zip(row[1:], kinds, strict=True)])
    if held:
        yield at, [np.concatenate(c) for c in zip(*held, strict=True)]


def ranked(found: np.ndarray, keys: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Shingles in the global order, rare before frequent: their level of frequency and the upper bits of their hash."""
    own = np.zeros(len(found), np.uint8)
    if len(keys):
        upper = (found >> U64(32)).astype(np.uint32)
        at = np.minimum(np.searchsorted(keys, upper), len(keys) - 1)
        own = np.where(keys[at] == upper, level[at], own)
    return np.sort(own.astype(U64) << U64(58) | found >> U64(6))


def prefix(found: np.ndarray, keys: np.ndarray, level: np.ndarray, num: int, den: int) -> tuple[np.ndarray, int]:
    """The chosen prefix of a set in the global order, and its l."""
    n = len(found)
    need = -(-num * n // den)
    order = ranked(found, keys, level)
    most = n - need + min(LONGEST, need)
    order = order[:most]
    read = np.cumsum(2.0 ** (order >> U64(58)).astype(np.float64) - 1)[n - need :]
    ell = 1 + int(np.argmin(read + VERIFY * read / np.arange(1, len(read) + 1)))
    return order[: n - need + ell], ell


KINDS = {"tok": np.uint64, "key": np.int64, "n": np.uint32, "pos": np.uint32, "ell": np.uint8, "flags": np.uint8, "grp": np.int64, "size": np.int64}


def _met(runs: DataFrame, ranges: int, names: list[str]) -> DataFrame:
    """Rows of the runs (range, tok, key, ... packed), a row for each token and class, of tokens of two or more classes."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, columns in _grouped(batches, tuple(KINDS[c] for c in names)):
            tok, key = columns[:2]
            order = np.lexsort((key, tok))
            tok, key = tok[order], key[order]
            fresh = np.concatenate(([True], (tok[1:] != tok[:-1]) | (key[1:] != key[:-1])))
            order, tok = order[fresh], tok[fresh]
            same = tok[1:] == tok[:-1]
            order = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))]
            for i in range(0, len(order), 20_000):
                part = order[i : i + 20_000]
                yield pa.RecordBatch.from_arrays([pa.array(c[part].view(np.int64) if c.dtype == U64 else c[part].astype(np.int64)) for c in columns], names=names)

    schema = ", ".join(f"{c} bigint" for c in names)
    return runs.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(lean(meet), schema)


def _runs(held: list[tuple[np.ndarray, dict[str, object]]], ranges: int, names: list[str]) -> pa.RecordBatch:
    """Tokens of several sets with what belongs to each set or token, packed by ranges of hashes."""
    tok = np.concatenate([h[0] for h in held])
    each = [len(h[0]) for h in held]
    columns = [np.concatenate([np.broadcast_to(np.asarray(h[1][c], KINDS[c]), n) for h, n in zip(held, each, strict=True)]) for c in names[1:]]
    made = list(zip(*_by_range(mixed(tok), ranges, tok, *columns), strict=True)) or [()] * (len(names) + 1)
    return pa.RecordBatch.from_arrays([pa.array(made[0], pa.int32()), *(pa.array(c, pa.binary()) for c in made[1:])], names=["range", *names])


def _packed(emitted: Iterator[tuple[np.ndarray, dict[str, object]]], ranges: int, names: list[str], flush: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for tok, about in emitted:
        held.append((tok, about))
        size += len(tok)
        if size >= flush:
            yield _runs(held, ranges, names)
            held, size = [], 0
    if held:
        yield _runs(held, ranges, names)


def postings(rows: DataFrame, k: int, seed: int, num: int, den: int, keys: np.ndarray, level: np.ndarray, ranges: int, flush: int = 250_000) -> DataFrame:
    """(tok, key, n, pos, ell) of all prefix shingles that two or more classes share."""
    shared = rows.sparkSession.sparkContext.broadcast((keys, level))
    names = ["tok", "key", "n", "pos", "ell"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chosen() -> Iterator[tuple[np.ndarray, dict[str, object]]]:
            for key, found in _distinct_sets(batches, k, seed):
                tok, ell = prefix(found, *shared.value, num, den)
                yield tok, {"key": key, "n": len(found), "pos": np.arange(len(tok)), "ell": ell}

        yield from _packed(chosen(), ranges, names, flush)

    return _met(rows.mapInArrow(lean(emit), "range int, " + ", ".join(f"{c} binary" for c in names)), ranges, names)


def _salted(df: DataFrame) -> DataFrame:
    """Rows of a group in SALTS parts by their key, so that no task gets all members of a group."""
    return df.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)))


def _for_each_salt(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))


DELTAS = "grp bigint, own boolean, size bigint, key bigint, n bigint, c bigint, near boolean, delta binary"


def deviations(members: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """members(grp, own, size, key, c) with n, near (whether key links with c) and delta: the shingles in only one of both."""

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, delta, n = [], [], []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                p, q = np.frombuffer(x, U64), np.frombuffer(y, U64)
                apart = np.setxor1d(p, q, assume_unique=True)
                near.append((den - num) * (len(p) + len(q)) >= (den + num) * len(apart))
                delta.append(apart.tobytes())
                n.append(len(p))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("grp", "own", "size", "key")), pa.array(n, pa.int64()), batch.column("c"), pa.array(near, pa.bool_()), pa.array(delta, pa.binary())], names=["grp", "own", "size", "key", "n", "c", "near", "delta"])

    centre = sets.join(members.select(F.col("c").alias("key")).distinct(), "key").select(F.col("key").alias("c"), F.col("found").alias("y"))
    both = _salted(members).join(sets.select("key", F.col("found").alias("x")), "key").join(_for_each_salt(centre), ["c", "salt"])
    return both.select("grp", "own", "size", "key", "c", "x", "y").mapInArrow(lean(differ), DELTAS)


SHARE = 64


def common_deviations(deltas: DataFrame, ranges: int, flush: int = 250_000) -> DataFrame:
    """grp, toks, counts: what a SHARE-th of a group's members (two at least) deviate in, and how many do. At most SHARE times the mean deviation."""
    names = ["tok", "grp", "size"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def all_of() -> Iterator[tuple[np.ndarray, dict[str, object]]]:
            for batch in batches:
                for grp, size, delta in zip(*(batch.column(c).to_pylist() for c in ("grp", "size", "delta")), strict=True):
                    yield np.frombuffer(delta, U64), {"grp": grp, "size": size}

        yield from _packed(all_of(), ranges, names, flush)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (tok, grp, size) in _grouped(batches, tuple(KINDS[c] for c in names)):
            order = np.lexsort((tok, grp))
            tok, grp, size = tok[order], grp[order], size[order]
            first = np.flatnonzero(np.concatenate(([True], (tok[1:] != tok[:-1]) | (grp[1:] != grp[:-1]))))
            c = np.diff(np.append(first, len(tok)))
            keep = c >= np.maximum(2, size[first] // SHARE)
            first, c = first[keep], c[keep]
            own, at = np.unique(grp[first], return_index=True)
            parts = [(g, tok[first[i:j]].tobytes(), c[i:j].astype(np.uint32).tobytes()) for g, i, j in zip(own.tolist(), at.tolist(), [*at[1:].tolist(), len(first)], strict=True)]
            g, toks, counts = zip(*parts, strict=True) if parts else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(toks, pa.binary()), pa.array(counts, pa.binary())], names=["grp", "toks", "counts"])

    runs = deltas.mapInArrow(lean(emit), "range int, " + ", ".join(f"{c} binary" for c in names))
    parts = runs.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(lean(count), "grp bigint, toks binary, counts binary")
    pairs = F.collect_list(F.struct("toks", "counts"))
    joined = lambda c: F.aggregate(pairs_of(c), F.lit(b""), lambda acc, x: F.concat(acc, x))
    pairs_of = lambda c: F.transform("parts", lambda p: p[c])
    return parts.groupBy("grp").agg(pairs.alias("parts")).select("grp", joined("toks").alias("toks"), joined("counts").alias("counts"))


def recentred(deltas: DataFrame, num: int, den: int, ranges: int) -> DataFrame:
    """Deviations from each group's most central member c, which has no row, with their prefixes: tokens, and how many meet any far member."""
    common = written(common_deviations(deltas, ranges), "common")

    def distance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for size, delta, toks, counts in zip(*(batch.column(c).to_pylist() for c in ("size", "delta", "toks", "counts")), strict=True):
                most = np.frombuffer(toks or b"", U64)[2 * np.frombuffer(counts or b"", np.uint32).astype(np.int64) > size]
                out.append(len(np.setxor1d(np.frombuffer(delta, U64), most, assume_unique=True)))
            yield pa.RecordBatch.from_arrays([batch.column("grp"), batch.column("key"), pa.array(out, pa.int64())], names=["grp", "key", "far"])

    about = _salted(deltas).join(_for_each_salt(common), ["grp", "salt"], "left")
    best = about.select("grp", "key", "size", "delta", "toks", "counts").mapInArrow(lean(distance), "grp bigint, key bigint, far bigint").groupBy("grp").agg(F.min_by("key", F.struct("far", "key")).alias("key"))
    centre = deltas.join(best, ["grp", "key"]).groupBy("grp").agg(F.min("key").alias("centre"), F.min("n").alias("nc"), F.min("delta").alias("origin"))
    centre = written(centre.join(common, "grp", "left"), "centre", 200)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for n, size, delta, nc, origin, toks, counts in zip(*(batch.column(c).to_pylist() for c in ("n", "size", "delta", "nc", "origin", "toks", "counts")), strict=True):
                origin, toks, counts = np.frombuffer(origin, U64), np.frombuffer(toks or b"", U64), np.frombuffer(counts or b"", np.uint32).astype(np.int64)
                own = np.setxor1d(np.frombuffer(delta, U64), origin, assume_unique=True)
                # The members that deviate in a shingle of the centre's own deviation are all the others.
                order = np.argsort(toks)
                toks, counts = toks[order], counts[order]
                often = np.zeros(len(own), np.int64)
                if len(toks):
                    at = np.minimum(np.searchsorted(toks, own), len(toks) - 1)
                    often = np.where(toks[at] == own, counts[at], 0)
                often = np.where(np.isin(own, origin, assume_unique=True), size - often, often)
                near = (den - num) * (n + nc) >= (den + num) * len(own)
                short, long = deviation_prefixes(len(own), n, nc, num, den)
                first = own[np.lexsort((own, often))][: short if near else max(short, long)]
                made.append((near, own.tobytes(), first.tobytes(), min(short, len(first)), *sketch(own)))
            near, delta, first, short, *bits = zip(*made, strict=True) if made else [()] * (4 + SKETCH)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("grp", "own", "key", "n", "centre")), pa.array(near, pa.bool_()), pa.array(delta, pa.binary()), pa.array(first, pa.binary()), pa.array(short, pa.int64()), *(pa.array(b, pa.int64()) for b in bits)], names=["grp", "own", "key", "n", "c", "near", "delta", "first", "short", *SKETCHED])

    moved = _salted(deltas).join(_for_each_salt(centre), ["grp", "salt"]).filter("key <> centre").select("grp", "own", "size", "key", "n", "delta", "centre", "nc", "origin", "toks", "counts")
    return moved.mapInArrow(lean(move), "grp bigint, own boolean, key bigint, n bigint, c bigint, near boolean, delta binary, first binary, short bigint, " + ", ".join(f"{c} bigint" for c in SKETCHED))


NEAR, SHORT, OWN = 1, 2, 4
SKETCH = 8  # 64-bit words of a deviation's sketch
SKETCHED = [f"s{i}" for i in range(SKETCH)]


def sketch(deviation: np.ndarray) -> list[int]:
    """For each of 64 * SKETCH buckets of hashes, whether an odd number of the deviation's shingles fall into it.

    Where the sketches of two deviations differ in b bits, the deviations, and hence the sets, differ in b shingles at least.
    """
    odd = np.bincount((deviation & U64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def sketches_fit(num: int, den: int) -> F.Column:
    """Whether sketches s0.. and t0.. of sets of n and n2 shingles leave room for a link."""
    apart = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"t{c[1:]}"))).cast("bigint") for c in SKETCHED), F.lit(0).cast("bigint"))
    return apart * (den + num) <= (F.col("n") + F.col("n2")) * (den - num)


def deviation_prefixes(d: int, n: int, nc: int, num: int, den: int) -> tuple[int, int]:
    """How many shingles of a deviation, rare before frequent, can meet: (with one far from c, for one far from c also with one near c).

    i and j link if and only if |D_i and D_j| >= (e_i + e_j) / 2, where e = d - K n and K = (den - num) / (den + num).
    A member j that is far from c, not linked with it, has e_j > K nc. So i shares more than (e_i + K nc) / 2 shingles of
    D_i with any far member. A near i that links with j has d_i >= |D_i and D_j|, hence shares at least e_j - K n_i with
    it, and num n_i <= den n_j.
    """
    short = max(1, -(-(d * (den + num) + (den - num) * (nc - n)) // (2 * (den + num))))
    long = max(1, -(-(d * num - n * (den - num)) // num))
    return max(0, d - short + 1), max(0, d - long + 1)


def deviation_lists(deltas: DataFrame, ranges: int, flush: int = 100_000) -> DataFrame:
    """(tok, key, n, flags, grp) of what deviations of one group share in their prefixes."""
    names = ["tok", "key", "n", "flags", "grp"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chosen() -> Iterator[tuple[np.ndarray, dict[str, object]]]:
            for batch in batches:
                for grp, own, key, n, near, first, short in zip(*(batch.column(c).to_pylist() for c in ("grp", "own", "key", "n", "near", "first", "short")), strict=True):
                    tok = np.frombuffer(first, U64)
                    flags = np.where(np.arange(len(tok)) < short, SHORT, 0) | (NEAR if near else 0) | (OWN if own else 0)
                    yield mixed(tok ^ mixed(np.full(1, grp, np.int64).view(U64))), {"key": key, "n": n, "flags": flags, "grp": grp}

        yield from _packed(chosen(), ranges, names, flush)

    return _met(deltas.mapInArrow(lean(emit), "range int, " + ", ".join(f"{c} binary" for c in names)), ranges, names)


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component) of the graph of edges(a, b)."""
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:  # every round but the last lowers a label
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = written(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        now = written(small, "small")
        was, mark = mark, now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == was:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _linked(pairs: DataFrame, sets: DataFrame, num: int, den: int, on: list[str] = []) -> DataFrame:  # noqa: B006
    """The pairs(a, b) whose sets(key, n, found) are similar enough; sets of `on` may hold deviations from one centre instead."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for i, (x, y, size) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("x", "y", "size")), strict=True)):
                both = np.sort(np.concatenate((np.frombuffer(x, U64), np.frombuffer(y, U64))))
                apart = len(both) - 2 * int((both[1:] == both[:-1]).sum())
                keep[i] = (den - num) * size >= (den + num) * apart
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    x, y = (sets.select(*on, F.col("key").alias(c), F.col("found").alias(f), F.col("n").alias(m)) for c, f, m in (("a", "x", "nx"), ("b", "y", "ny")))
    both = pairs.join(x, [*on, "a"]).join(y, [*on, "b"])
    return both.select("a", "b", "x", "y", (F.col("nx") + F.col("ny")).alias("size")).mapInArrow(lean(verify), "a bigint, b bigint")


def _possible(num: int, den: int) -> F.Column:
    """Length and position leave room for a link: columns n, pos and n2, pos2."""
    room = F.least("pos", "pos2") + 1 + F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2")) - 1
    return (F.least("n", "n2") * den >= F.greatest("n", "n2") * num) & (room * (num + den) >= (F.col("n") + F.col("n2")) * num)


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, known: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, n_shingles, component_id (the least id reachable by links)."""
    with scratch(docs.sparkSession, {"listed", "classes", "labels"}):
        return _near_duplicates(docs, k, num, den, known, id_col, text_col)


def _near_duplicates(docs: DataFrame, k: int, num: int, den: int, known: int, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    for seed in range(8):
        listed = written(_documents(rows, k, seed), "listed")
        classes = written(listed.filter("id IS NOT NULL AND n > 0").groupBy("key").agg(F.min("id").alias("least"), F.min("key2").alias("lo"), F.max("key2").alias("hi"), F.max("n").alias("n")), "classes")
        if classes.filter("lo <> hi").isEmpty():
            break  # no two different sets share a key
    else:
        raise ValueError("different sets share a key under each of eight seeds")
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranges = max(12, int(total) // 500_000)  # about so many shingles meet in a task
    keys, level = frequent(rows, k, seed, ranges, known)
    lists = written(postings(rows, k, seed, num, den, keys, level, ranges), "lists")
    freed(lists)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            want, out = batch.column("key").to_pylist(), []
            for i, found in _sets(batch, k):
                out.append(found.tobytes() if class_key(found, seed)[0] == want[i] else None)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.binary())], names=["key", "found"])

    def sets_of(needed: DataFrame) -> DataFrame:
        """key, n, found: the whole sets of the classes in needed(key)."""
        needed = written(needed.distinct().join(classes, "key").select("key", F.col("least").alias("id")), "needed")
        chosen = rows.join(broadcast_if_small(needed, needed.count(), 16), "id").select("key", "text").mapInArrow(lean(emit), "key bigint, found binary")
        found = freed(written(chosen.filter("found IS NOT NULL").dropDuplicates(["key"]), "sets", 200))
        return found.withColumn("n", F.octet_length("found") / 8)

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key")))

    # The centre of each list against its other members.
    centres = lists.groupBy("tok").agg(F.min(F.struct("pos", "key", "n")).alias("c")).select("tok", F.col("c.key").alias("a"), F.col("c.n").alias("n2"), F.col("c.pos").alias("pos2"))
    # A member meets the two centres with which it shares most lists; whatever that leaves apart is matched below.
    stars = lists.join(centres, "tok").filter((F.col("a") != F.col("key")) & _possible(num, den)).groupBy("a", F.col("key").alias("b")).agg(F.count("*").alias("c"))
    best = stars.groupBy("b").agg(F.max_by("a", F.struct("c", "a")).alias("a1"), F.max("c").alias("c1"))
    least = stars.join(best, "b").filter("a <> a1").groupBy("b").agg(F.max_by("a", F.struct("c", "a")).alias("a"))
    stars = written(best.select(F.col("a1").alias("a"), "b").unionByName(least.select("a", "b")), "stars")
    links = freed(written(_linked(stars, sets_of(ends(stars)), num, den), "links", 64))
    roots = components(links)

    def rooted(lists: DataFrame, roots: DataFrame) -> DataFrame:
        """lists with each member's component, of those that hold several: and the largest of these, major, and the list's members."""
        own = written(lists.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key")), "rooted")
        sizes = own.groupBy("tok", "root").agg(F.count("*").alias("c"))
        several = sizes.groupBy("tok").agg(F.max_by("root", F.struct("c", "root")).alias("major"), F.count("*").alias("roots"), F.sum("c").alias("members"))
        return own.join(several.filter("roots > 1").drop("roots"), "tok")

    # Large lists of several components: every member against its list's centre.
    mixed_lists = written(rooted(lists, roots), "mixed")
    large = mixed_lists.filter(F.col("members") > SMALL)
    in_large = written(large.groupBy("key").agg(F.count("*").alias("large")), "large")
    deltas = None
    if not in_large.isEmpty():
        # Linked sets differ in size by den / num at most: their bands are the same or next to each other.
        band = F.floor(F.log("n") / np.log(den / num) + 1e-9).cast("bigint")
        # Linked documents also share a shingle of their 1-prefixes; where that one's list is small, they meet there.
        foremost = large.filter(F.col("pos") <= F.col("n") - F.ceil(F.col("n") * num / den))
        banded = foremost.join(in_large, "key").select("tok", "key", F.struct("large", "key").alias("rank"), F.posexplode(F.array(band, band + 1)).alias("own", "g"))
        # Of each list the member of most large lists; lists whose chosen members meet in another list go with that list's.
        banded = written(banded.withColumn("own", F.col("own") == 0), "banded")
        chosen = banded.groupBy("tok", "g").agg(F.max("rank").alias("top"), F.count("*").alias("members")).filter("members > 1").select("tok", "g", "top")
        for _ in range(2):  # on written tables, and for the chosen members alone: a member's rows are joined once, below
            chosen = written(chosen, "chosen")
            tops = chosen.select(F.col("top.key").alias("key"), "g").distinct()
            above = banded.join(tops, ["key", "g"], "left_semi").join(chosen, ["tok", "g"]).groupBy("key", "g").agg(F.max("top").alias("above"))
            chosen = chosen.join(above, (above["key"] == F.col("top.key")) & (above["g"] == chosen["g"]), "left").select("tok", chosen["g"], F.coalesce("above", "top").alias("top"))
        chosen = written(chosen, "chosen")
        members = banded.join(chosen, ["tok", "g"]).select(F.xxhash64("top.key", "g").alias("grp"), "own", F.col("top.key").alias("c"), "key").distinct()
        members = written(members, "members")
        members = members.join(members.groupBy("grp").agg(F.count("*").alias("size")), "grp")
        found = sets_of(members.select("key").unionByName(members.select(F.col("c").alias("key"))))
        first = freed(written(deviations(members, found, num, den), "deltas", 200))
        deltas = freed(written(recentred(first, num, den, 12), "moved", 200))
        near = first.filter("near AND c <> key").unionByName(deltas.filter("near"), allowMissingColumns=True)
        links = written(links.unionByName(near.select(F.col("c").alias("a"), F.col("key").alias("b"))), "links")
        roots = components(links)

    # Small lists of several components, pair by pair.
    small = rooted(mixed_lists.filter(F.col("members") <= SMALL).select("tok", "key", "n", "pos", "ell"), roots).join(in_large, "key", "left").withColumn("large", F.coalesce("large", F.lit(0)))
    small = written(small, "small")
    other = small.select("tok", F.col("key").alias("b"), F.col("n").alias("n2"), F.col("pos").alias("pos2"), F.col("ell").alias("ell2"), F.col("root").alias("root2"), F.col("large").alias("large2"))
    outside = small.filter("root <> major")
    pairs = outside.join(other, "tok").filter((F.col("root") != F.col("root2")) & ((F.col("root2") == F.col("major")) | (F.col("key") < F.col("b"))) & _possible(num, den))
    # Of two documents' common shingles all but those behind the prefix of one of them are counted; large lists are not here.
    behind = lambda n, ell: F.ceil(F.col(n) * num / den) - F.col(ell)
    needed = F.ceil((F.col("n") + F.col("n2")) * num / (num + den)) - F.greatest(behind("n", "ell"), behind("n2", "ell2"))
    enough = F.greatest(needed, F.least("ell", "ell2")) - F.least("large", "large2")
    pairs = pairs.groupBy(F.least("key", "b").alias("a"), F.greatest("key", "b").alias("b2")).agg(F.count("*").alias("c"), F.max(enough).alias("least")).filter("c >= least").select("a", F.col("b2").alias("b"))
    done = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = written(pairs.join(done, ["a", "b"], "left_anti"), "pairs")
    more = written(_linked(pairs, sets_of(ends(pairs)), num, den), "more", 64)
    if deltas is not None:
        met = rooted(deviation_lists(deltas, 12), roots)
        met = met.join(deltas.select("grp", "key", *SKETCHED), ["grp", "key"])
        met = written(met.select("tok", "key", "n", "grp", "root", *SKETCHED, *(F.col("flags").bitwiseAND(bit).cast("boolean").alias(c) for c, bit in (("near", NEAR), ("short", SHORT), ("own", OWN)))), "met")
        other = met.select("tok", F.col("key").alias("b"), F.col("n").alias("n2"), F.col("root").alias("root2"), F.col("near").alias("near2"), F.col("short").alias("short2"), F.col("own").alias("own2"), *(F.col(c).alias(f"t{c[1:]}") for c in SKETCHED))
        alike = (F.least("n", "n2") * den >= F.greatest("n", "n2") * num) & (F.col("own") | F.col("own2"))  # both from below: they meet in their own band
        pairs = met.filter("NOT near").join(other, "tok").filter((F.col("root") != F.col("root2")) & (F.col("near2") | (F.col("short") & F.col("short2") & (F.col("key") < F.col("b")))) & alike & sketches_fit(num, den))
        pairs = written(pairs.groupBy(F.col("key").alias("a"), "b").agg(F.min("grp").alias("grp")), "pairs")
        more = more.unionByName(written(_linked(pairs, deltas.select("grp", "key", "n", F.col("delta").alias("found")), num, den, ["grp"]), "more", 64))
    if not more.isEmpty():
        roots = components(links.unionByName(more))

    named = roots.select("node", "root").unionByName(roots.select(F.col("root").alias("node"), "root").distinct()).join(classes.select(F.col("key").alias("node"), "least"), "node")
    label = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = written(named.join(label, "root").select(F.col("node").alias("key"), "component_id"), "labels")
    by_class = classes.join(of_class, "key", "left").select("key", F.coalesce("component_id", "least").alias("component_id"))
    linkable = listed.filter("id IS NOT NULL AND n > 0").join(by_class, "key").select("id", F.col("n").alias("n_shingles"), "component_id")
    alone = listed.filter("id IS NULL OR n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return linkable.unionByName(alone)


def op8_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or more."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=3, num=90, den=100)
    return found.withColumnRenamed("id", "doc_id")
