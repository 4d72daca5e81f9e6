"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

Texts are cut into words by the byte-level pattern, vectorised over the UTF-8 bytes of a whole batch; equal words of a
batch are encoded once. A word's adjacent pairs are the leaves of a segment tree whose nodes hold the least
(rank, position): the root is the leftmost lowest-rank merge. Words of like length are merged in step, each in its own
tree, by the same point updates on arrays. A merge changes three leaves, each in logarithmic time,
until the root holds no mergeable pair. Decoding gathers the bytes of all ids at once.

Defined cases: null counts as empty and gives no ids; the special token's own string becomes its id; bytes that are no
UTF-8 after decoding (possible only for ids that no text gives) become U+FFFD; repeated rows give repeated results;
other columns are carried or ignored by the caller's choice; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sendero.llm._common import lean, pieces, prefix_sums, span_hashes, strings

NEVER = 1 << 62
OTHER, LETTER, NUMBER, SPACE = range(4)
#: The characters of White_Space.
WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
PIECE = 1 << 18
SLOTS, STORE = 1 << 18, 1 << 21  # words and ids that a worker keeps between batches
TOGETHER = 65  # words of at most so many bytes advance together
HEAD = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


@lru_cache(1)
def classes() -> np.ndarray:
    """Of each code point: letter, number, white space or other."""
    out = np.zeros(0x110000, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for cp in range(0x110000):
        out[cp] = kinds.get(unicodedata.category(chr(cp))[0], OTHER)
    out[WHITE] = SPACE
    return out


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBPE:
    def __init__(self, path: str) -> None:
        made = json.loads(open(path, encoding="utf-8").read())
        back = byte_characters()
        vocab: dict[str, int] = made["model"]["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in made["added_tokens"]}
        merges = [m if isinstance(m, list) else m.split(" ") for m in made["model"]["merges"]]
        self.pairs = {vocab[a] << 32 | vocab[b]: (rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        keys = np.array(list(self.pairs), np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.pairs.values()], np.int64)[order]
        self.merged = np.array([m for _, m in self.pairs.values()], np.int64)
        self.of_byte = [0] * 256
        for char, b in back.items():
            self.of_byte[b] = vocab[char]
        size = max([*vocab.values(), *self.special.values()]) + 1
        raw = [b""] * size
        for token, i in vocab.items():
            raw[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            raw[i] = token
        self.lengths = np.array([len(x) for x in raw], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.flat = np.frombuffer(b"".join(raw), np.uint8)
        self.byte_ids = np.array(self.of_byte, np.int64)
        # A direct-mapped cache of words: hash, first bytes and length; place and number of the ids in the store.
        self.store, self.used = np.zeros(STORE, np.uint32), 0
        self.slot_hash, self.slot_head = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint64)
        self.slot_size, self.slot_base, self.slot_count = np.full(SLOTS, -1), np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)

    def word(self, raw: bytes) -> tuple[int, ...]:
        """Ids of one word."""
        ids = [self.of_byte[b] for b in raw]
        n = len(ids)
        if n < 2:
            return tuple(ids)
        get = self.pairs.get
        size = 1 << (n - 2).bit_length()
        tree = [NEVER] * (2 * size)
        for i in range(n - 1):
            if found := get(ids[i] << 32 | ids[i + 1]):
                tree[size + i] = found[0] << 32 | i
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(leaf: int, key: int) -> None:
            node = leaf + size
            tree[node] = key
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    break
                tree[node] = least

        while (root := tree[1]) < NEVER:
            i = root & 0xFFFFFFFF
            j = after[i]
            ids[i] = get(ids[i] << 32 | ids[j])[1]
            ids[j] = -1
            after[i] = k = after[j]
            if j < n - 1 or k < n:
                put(j, NEVER)
            if k < n:
                before[k] = i
                found = get(ids[i] << 32 | ids[k])
                put(i, found[0] << 32 | i if found else NEVER)
            else:
                put(i, NEVER)
            if (h := before[i]) >= 0:
                found = get(ids[h] << 32 | ids[i])
                put(h, found[0] << 32 | h if found else NEVER)
        return tuple(x for x in ids if x >= 0)

    def _keys(self, a: np.ndarray, b: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """Of each pair at a leaf: rank << 32 | leaf, or NEVER."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.pair_keys[at] == key), self.pair_ranks[at] << 32 | leaf, NEVER)

    def many(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at start, one after the other, and their counts.

        Words of like length advance together, each in its own segment tree; long ones go through word().
        """
        count = np.zeros(len(start), np.int64)
        parts, order = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

        def put(own: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
            count[own] = counts
            parts.append(ids)
            order.append(np.repeat(own, counts))

        one = np.flatnonzero(size == 1)
        put(one, self.byte_ids[data[start[one]]], np.ones(len(one), np.int64))
        leaves, low = 1, 2
        while leaves < TOGETHER:
            own = np.flatnonzero((size >= low) & (size <= leaves + 1))
            for k in range(0, len(own), 8192):
                part = own[k : k + 8192]
                put(part, *self._together(data, start[part], size[part], leaves))
            low, leaves = leaves + 2, leaves * 2
        for i in np.flatnonzero(size >= low).tolist():
            ids = np.array(self.word(data[start[i] : start[i] + size[i]].tobytes()), np.int64)
            put(np.array([i]), ids, np.array([len(ids)]))
        return np.concatenate(parts)[np.argsort(np.concatenate(order), kind="stable")], count

    def _together(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The loop of word() over words of at most size + 1 bytes; row r of the flat tree starts at r * 2 * size."""
        rows, wide = len(start), size + 2
        place = np.arange(wide)
        symbol = data[np.minimum(start[:, None] + place, len(data) - 1)]
        ids = np.where(place < length[:, None], self.byte_ids[symbol], -1)
        tree = np.full((rows, 2 * size), NEVER, np.int64)
        tree[:, size:] = self._keys(ids[:, :size], ids[:, 1 : size + 1], np.arange(size))
        level = size
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        after = np.tile(np.minimum(np.arange(1, wide + 1), wide - 1), (rows, 1))
        before = np.tile(np.arange(-1, wide - 1), (rows, 1))
        ids, tree, after, before = ids.ravel(), tree.ravel(), after.ravel(), before.ravel()
        live = np.arange(rows)
        while True:
            root = tree[live * (2 * size) + 1]
            going = root < NEVER
            live, root = live[going], root[going]
            if not len(live):
                break
            base, at = live * (2 * size), live * wide
            i = root & 0xFFFFFFFF
            j = after[at + i]
            k = after[at + j]
            h = before[at + i]
            new = self.merged[root >> 32]
            ids[at + i], ids[at + j] = new, -1
            after[at + i], before[at + k] = k, i
            inner, left = j < size, h >= 0
            tree[(base + size + j)[inner]] = NEVER
            tree[base + size + i] = self._keys(new, ids[at + k], i)
            tree[(base + size + h)[left]] = self._keys(ids[(at + h)[left]], new[left], h[left])
            paths = [(base, size + i), (base[inner], (size + j)[inner]), (base[left], (size + h)[left])]
            level = size
            while level > 1:
                level //= 2
                paths = [(b, node >> 1) for b, node in paths]
                for b, node in paths:
                    two = b + 2 * node
                    tree[b + node] = np.minimum(tree[two], tree[two + 1])
        ids = ids.reshape(rows, wide)
        kept = ids >= 0
        return ids[kept], kept.sum(axis=1)

    def word_bounds(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Byte starts of the words of texts laid end to end, and (start, end, id) of the special tokens among them."""
        specials, raw = [], data.tobytes() if self.special else b""
        for token, i in self.special.items():
            at = raw.find(token)
            while at >= 0:
                if np.searchsorted(offsets, at, "right") == np.searchsorted(offsets, at + len(token) - 1, "right"):
                    specials.append((at, at + len(token), i))
                    at = raw.find(token, at + len(token))
                else:
                    at = raw.find(token, at + 1)
        bounds = np.concatenate((offsets[:-1], [x for s, e, _ in specials for x in (s, e)])).astype(np.int64)
        start = np.flatnonzero((data & 0xC0) != 0x80)
        n = len(start)
        if not n:
            return start, []
        cp = data[start].astype(np.int32)
        wide = np.flatnonzero(cp >= 0x80)
        if len(wide):
            at, lead = start[wide], cp[wide]
            last = len(data) - 1
            b1, b2, b3 = (data[np.minimum(at + k, last)].astype(np.int32) & 0x3F for k in (1, 2, 3))
            cp[wide] = np.where(lead < 0xE0, (lead & 0x1F) << 6 | b1, np.where(lead < 0xF0, (lead & 0x0F) << 12 | b1 << 6 | b2, (lead & 0x07) << 18 | b1 << 12 | b2 << 6 | b3))
        kind = classes()[cp]
        section = np.zeros(n + 1, bool)
        section[np.searchsorted(start, bounds)] = True
        section[[0, n]] = True
        run = section[:n].copy()
        run[1:] |= kind[1:] != kind[:-1]
        white = kind == SPACE
        token = np.zeros(n + 4, bool)
        token[:n] = run & white
        opens = np.flatnonzero(run & ~white)
        follows = opens[(opens > 0) & ~section[opens] & white[opens - 1]]
        token[follows - 1] = True
        token[:n] |= run & ~white
        token[follows[cp[follows - 1] == 0x20]] = False
        # Contractions: an apostrophe that opens a word, and s t m d re ve ll after it in the same section.
        quote = np.flatnonzero((cp == 0x27) & run & token[:n])
        for tail in ("s", "t", "m", "d", "re", "ve", "ll"):
            k = len(tail)
            at = quote[quote + k < n]
            for i, c in enumerate(tail, 1):
                at = at[(cp[at + i] == ord(c)) & ~section[at + i]]
            token[at + 1] = False
            token[at + k + 1] = True
        for s, e, _ in specials:
            token[np.searchsorted(start, s) + 1 : np.searchsorted(start, e)] = False
        return start[np.flatnonzero(token[:n])], specials

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts laid end to end, and the n+1 offsets of each text's ids."""
        start, specials = self.word_bounds(data, offsets)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        size = np.diff(np.append(start, len(data)))
        hashes = span_hashes(prefix_sums(data), start, start + size)
        # Words are equal if hash, length and the first eight bytes are.
        eight = np.lib.stride_tricks.as_strided(np.concatenate((data, np.zeros(8, np.uint8))), (len(data), 8), (1, 1))
        heads = eight[start].copy().view("<u8").ravel() & HEAD[np.minimum(size, 8)]
        codes, unique = pd.factorize(hashes)
        first = np.zeros(len(unique), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        if len(odd := np.flatnonzero((size != size[first[codes]]) | (heads != heads[first[codes]]))):
            codes[odd] = len(first) + np.arange(len(odd))
            first = np.concatenate((first, odd))
        base, count = self._cached(data, start[first], size[first], hashes[first], heads[first])
        for s, _, i in specials:
            k = int(np.searchsorted(start, s))
            codes[k] = len(base)
            base, count = np.append(base, i), np.append(count, -1)
        each = np.abs(count)[codes]
        ends = np.cumsum(each)
        ids = self.store[np.repeat(np.where(count < 0, 0, base)[codes] - (ends - each), each) + np.arange(ends[-1])]
        for s, _, i in specials:
            k = int(np.searchsorted(start, s))
            ids[ends[k] - 1] = i
        return ids, np.concatenate(([0], ends))[np.searchsorted(start, offsets)]

    def _cached(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, hashes: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in the store each word's ids are, and how many; new words are encoded and take their slot."""
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        base, count = self.slot_base[slot], self.slot_count[slot]
        new = np.flatnonzero((self.slot_hash[slot] != hashes) | (self.slot_head[slot] != heads) | (self.slot_size[slot] != size))
        ids, made = self.many(data, start[new], size[new])
        if self.used + len(ids) > len(self.store):  # forget all; what this batch needs is encoded again
            self.slot_size[:] = -1
            self.used = 0
            self.store = np.zeros(STORE, np.uint32)
            if len(new) < len(start):
                ids, made = self.many(data, start, size)
                new = np.arange(len(start))
            if len(ids) > STORE:
                self.store = np.zeros(len(ids), np.uint32)
        self.store[self.used : self.used + len(ids)] = ids
        base[new], count[new] = self.used + np.cumsum(made) - made, made
        self.used += len(ids)
        at = slot[new]
        self.slot_hash[at], self.slot_head[at], self.slot_size[at] = hashes[new], heads[new], size[new]
        self.slot_base[at], self.slot_count[at] = base[new], made
        return base, count

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of id lists laid end to end, and the n+1 offsets of each list's bytes."""
        each = self.lengths[ids]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        data = self.flat[np.repeat(self.starts[ids] - (ends - each), each) + np.arange(total)]
        return data, np.concatenate(([0], ends)).astype(np.int64)[offsets]


@lru_cache(4)
def tokenizer(path: str) -> ByteBPE:
    """One tokenizer, and its cache of words, for each worker process."""
    return ByteBPE(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, ids (array of int)."""
    file = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(file)
        for batch in batches:
            data, offsets = strings(batch.column("text"))
            for a, b in pieces(offsets, PIECE):
                ids, at = bpe.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))], names=["id", "ids"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(lean(run), f"id {docs.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """One row for each row of encoded(id, ids): id, text."""
    file = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(file)
        for batch in batches:
            texts = [bytes(bpe.decode(np.array(x or [], np.int64), np.array([0, len(x or [])]))[0]).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    return encoded.select("id", "ids").mapInArrow(lean(run), f"id {encoded.schema['id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, n_tokens, ids_sha256 (of 32-bit little-endian ids), decoded_sha256."""
    file = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(file)
        for batch in batches:
            data, offsets = strings(batch.column("text"))
            for a, b in pieces(offsets, PIECE):
                ids, at = bpe.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                text, cut = bpe.decode(ids, at)
                little = ids.astype("<u4")
                hashed = [hashlib.sha256(little[s:e].tobytes()).hexdigest() for s, e in zip(at[:-1], at[1:], strict=True)]
                decoded = [hashlib.sha256(text[s:e].tobytes().decode("utf-8", "replace").encode()).hexdigest() for s, e in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), pa.array(np.diff(at)), pa.array(hashed, pa.string()), pa.array(decoded, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])
        tokenizer.cache_clear()  # the worker, which stays, is not to hold its tables through the steps that follow

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(lean(run), f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op3_bpe(spark, sf_dir: str) -> DataFrame:
    """Every text of documents encoded and decoded."""
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")
