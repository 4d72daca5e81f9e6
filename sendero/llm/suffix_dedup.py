"""Removal of repeated spans by sparse suffix arrays with deep-shallow sorting.

A byte goes if it lies in a string of `length` bytes that also starts anywhere else, in the same text or another. Every
start i has an anchor: the place of the least (then leftmost) hash of the `gram`-byte strings inside [i, i + length).
Equal strings have equal anchors at equal offsets, so starts need comparing only with starts of the same anchor hash.

1. Texts are told apart by SHA-256; a text with copies goes whole (if it has `length` bytes), one copy stands for all.
2. Anchor hashes that occur once are settled; of the others, each anchor's context (the bytes of all strings that it
   owns) is brought together by hash.
3. In a group two suffix arrays are built, of the bytes from the anchor on and of the bytes before it, backwards:
   multikey quicksort by eight bytes at a time to a shallow depth, and a blind trie for what still agrees there. With
   the LCPs, the strings at offset s agree exactly where both arrays keep two contexts together, to depth length - s
   and s. Agreement changes only at the LCPs, so a few offsets are looked at for each group.
4. A group of more than `most` contexts is not brought together. Its equal contexts become one, with their number. If
   that leaves too many, the offsets are halved: strings at offsets s to t agree in the s bytes before the anchor and the
   length - t from it on, so each half is dealt by those bytes into groups of its own, again and again where need be. At
   a single offset these bytes are the whole string, and what shares them is repeated.

`repeated_words` finds runs of words in the same way: a text is the sequence of 64-bit hashes of its words, eight bytes to
a symbol, so that a passage counts by its words, however short these are.

Defined cases: null counts as empty; texts shorter than `length` lose nothing; each row gives one row, also where the
id is null or repeated (a repeated row is a copy); other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sendero.llm._common import NOT_SPACE, U64, broadcast_if_small, digest, lean, mixed, pieces, powers, prefix_sums, scratch, strings, word_hashes, words, written

SHALLOW, STEP = 32, 8
PLACE = (1 << 21) - 1
PART = 1 << 20


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first start, last start, hash) of every anchor of texts laid end to end, at most PLACE bytes; ends: of the texts."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.astype(U64)
    sums = prefix_sums(data)
    grams = n - gram + 1
    found = mixed((sums[gram:] - sums[:grams]) * powers(n + 1)[1][:grams])
    width = length - gram + 1
    key = np.full(-(-grams // width) * width, ~U64(0))
    key[:grams] = found & ~U64(PLACE) | np.arange(grams, dtype=U64)
    rows = key.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - length + 1
    own = (np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts]) & U64(PLACE)).astype(np.int64)
    begins = np.concatenate(([0], ends[:-1]))
    inside = np.zeros(n + 1, np.int64)
    long = ends - begins >= length
    np.add.at(inside, begins[long], 1)
    np.add.at(inside, ends[long] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(inside[:starts]))
    if not len(at):
        return none, none, none, none.astype(U64)
    own = own[at]
    first = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1))))
    last = np.append(first[1:], len(at)) - 1
    return own[first], at[first], at[last], found[own[first]]


def text_anchors(data: np.ndarray, length: int, gram: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """anchors() of one text of any length, part by part: (where the part begins, ...)."""
    for base in range(0, max(1, len(data) - length + 1), PART):
        part = data[base : base + PART + length - 1]
        yield base, *anchors(part, np.array([len(part)]), length, gram)


def lcp(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x, y = a[:n], b[:n]
    if x == y:
        return n
    return n - ((int.from_bytes(x) ^ int.from_bytes(y)).bit_length() + 7) // 8


def blind_trie(texts: list[bytes], own: list[int]) -> list[int]:
    """own sorted by its texts: each goes in by one blind descent, one comparison and one descent to its place.

    A node is [depth, {byte or -1 at the text's end: node or leaf}]; a leaf is a list of equal texts.
    """
    root: list = [own[0]]
    top: list = [0, {-2: root}]  # an entry above the root
    for i in own[1:]:
        text = texts[i]
        node = top[1][-2]
        while isinstance(node[-1], dict):
            depth, below = node
            byte = text[depth] if depth < len(text) else -1
            node = below[byte] if byte in below else next(iter(below.values()))
        like = texts[node[0]]
        if like == text:
            node.append(i)
            continue
        depth = lcp(like, text)
        above, edge = top[1], -2
        node = above[edge]
        while isinstance(node[-1], dict) and node[0] < depth:
            above, edge = node[1], text[node[0]]
            node = above[edge]
        mine = text[depth] if depth < len(text) else -1
        if isinstance(node[-1], dict) and node[0] == depth:
            node[1][mine] = [i]
        else:
            theirs = like[depth] if depth < len(like) else -1
            above[edge] = [depth, {theirs: node, mine: [i]}]
    out, work = [], [top[1][-2]]
    while work:
        node = work.pop()
        if isinstance(node[-1], dict):
            work.extend(node[1][b] for b in sorted(node[1], reverse=True))
        else:
            out.extend(node)
    return out


def deep_shallow(texts: list[bytes]) -> list[int]:
    """Indices in the order of the texts."""
    out, work = [], [(list(range(len(texts))), 0)]
    while work:
        own, depth = work.pop()
        if len(own) < 2:
            out.extend(own)
        elif depth >= SHALLOW:
            out.extend(blind_trie(texts, own))
        else:
            keys = [texts[i][depth : depth + STEP] for i in own]
            pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
            less = [i for i, k in zip(own, keys, strict=True) if k < pivot]
            same = [i for i, k in zip(own, keys, strict=True) if k == pivot]
            more = [i for i, k in zip(own, keys, strict=True) if k > pivot]
            work.append((more, depth))
            if len(pivot) < STEP:  # the texts end here and are equal
                work.extend(([i], depth) for i in reversed(same))
            else:
                work.append((same, depth + STEP))
            work.append((less, depth))
    return out


def repeats(contexts: list[tuple[int, int, bytes]], weights: list[int], length: int, unit: int = 1, within: tuple[int, int] = (0, 1 << 40)) -> list[list[tuple[int, int]]]:
    """For each distinct (most, least offset before the anchor, context): the offset ranges [s, t) of repeated strings.

    weights: how often each context occurs; unit: bytes of a symbol, of which length and offsets are numbers; within: the
    least and the most offset that count.
    """
    g = len(contexts)
    low, top = [max(c[1], within[0]) for c in contexts], [min(c[0], within[1]) for c in contexts]
    own = [[(a, b + 1)] if w > 1 and a <= b else [] for a, b, w in zip(low, top, weights, strict=True)]
    if g == 1 or (g == 2 and min(weights) > 1):
        return own
    right = [c[high * unit :] for high, _, c in contexts]
    left = [c[: high * unit][::-1] for high, _, c in contexts]
    if g == 2:
        s, t = max(*low, length - lcp(*right) // unit), min(*top, lcp(*left) // unit) + 1
        both = [(s, t)] if s < t else []
        return [both + x for x in own]
    order_l, order_r = np.array(deep_shallow(left)), np.array(deep_shallow(right))
    lcp_l = np.array([lcp(left[i], left[j]) // unit for i, j in zip(order_l[:-1], order_l[1:], strict=True)], np.int64)
    lcp_r = np.array([lcp(right[i], right[j]) // unit for i, j in zip(order_r[:-1], order_r[1:], strict=True)], np.int64)
    high, low = np.array(top), np.array(low)
    weight = np.array(weights)
    cuts = np.unique(np.concatenate((lcp_l + 1, length - lcp_r, low, high + 1)))
    cuts = cuts[(cuts >= low.min()) & (cuts <= high.max() + 1)]
    found: list[list[tuple[int, int]]] = [[] for _ in range(g)]
    class_l, class_r = np.zeros(g, np.int64), np.zeros(g, np.int64)
    for s, t in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        class_l[order_l[1:]] = np.cumsum(lcp_l < s)
        class_r[order_r[1:]] = np.cumsum(lcp_r < length - s)
        here = np.flatnonzero((low <= s) & (s <= high))
        _, of, = np.unique(class_l[here] * g + class_r[here], return_inverse=True)
        total = np.bincount(of, weight[here])
        for i in here[total[of] > 1].tolist():
            if found[i] and found[i][-1][1] == s:
                found[i][-1] = (found[i][-1][0], t)
            else:
                found[i].append((s, t))
    return found


def symbols(data: np.ndarray, offsets: np.ndarray, unit: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of texts laid end to end, and where each text's end: bytes, or hashes of words."""
    if unit == 1:
        return data, offsets[1:]
    start, end, first = words(data, offsets, NOT_SPACE)
    return word_hashes(data, start, end), first[1:]


GROUPED = "h bigint, digest binary, high int, low int, context binary, at array<bigint>"
STARTS = "digest binary, spans array<struct<first:bigint,last:bigint>>"


def _seen_once(batches: Iterator[pa.RecordBatch], remember: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Rows without those whose digest this task still remembers."""
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for key in batch.column("digest").to_pylist():
            keep.append(key not in seen)
            seen.add(key)
        yield batch.filter(pa.array(keep, pa.bool_()))
        if len(seen) > remember:
            seen.clear()


def _anchor_hashes(rows: DataFrame, length: int, gram: int, unit: int) -> DataFrame:
    """(h, digest, c): how often each anchor hash occurs in each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _seen_once(batches):
            data, offsets = strings(batch.column("text"))
            for a, b in pieces(offsets):
                own, ends = symbols(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], unit)
                parts = [(0, *anchors(own, ends, length, gram))] if len(own) <= PART else text_anchors(own, length, gram) if b == a + 1 else _each(own, ends, length, gram)
                text, found = [], []
                for base, at, _, _, h in parts:
                    text.append(np.searchsorted(ends, at + base, "right"))
                    found.append(h)
                text, found = np.concatenate(text), np.concatenate(found)
                order = np.lexsort((found, text))
                text, found = text[order], found[order]
                first = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (found[1:] != found[:-1])))) if len(text) else np.zeros(0, np.int64)
                count = np.diff(np.append(first, len(text)))
                yield pa.RecordBatch.from_arrays([pa.array(found[first].view(np.int64)), batch.column("digest").take(pa.array(text[first] + a)), pa.array(count.astype(np.int64))], names=["h", "digest", "c"])

    return rows.mapInArrow(lean(run), "h bigint, digest binary, c bigint")


def _each(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """text_anchors() of several texts, one after the other."""
    for start, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
        for base, *found in text_anchors(data[start:end], length, gram):
            yield start + base, *found


def _contexts(texts: DataFrame, length: int, gram: int, unit: int) -> DataFrame:
    """The contexts of the anchors whose hashes (hs) occur again; equal contexts of a text in one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, hs in zip(*(batch.column(c).to_pylist() for c in ("digest", "text", "hs")), strict=True):
                text, wanted = np.frombuffer(text.encode(), np.uint8), np.sort(np.array(hs, np.int64))
                own, _ = symbols(text, np.array([0, len(text)]), unit)
                raw = own.tobytes()
                merged: dict[tuple, list[int]] = {}
                for base, at, first, last, h in text_anchors(own, length, gram):
                    h = h.view(np.int64)
                    keep = wanted[np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)] == h
                    for p, s, e, x in zip(at[keep].tolist(), first[keep].tolist(), last[keep].tolist(), h[keep].tolist(), strict=True):
                        merged.setdefault((x, p - s, p - e, raw[(base + s) * unit : (base + e + length) * unit]), []).append(base + p)
                rows = list(merged.items())
                for i in range(0, len(rows), 2000):
                    part = rows[i : i + 2000]
                    h, high, low, context = zip(*(k for k, _ in part), strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array([key] * len(part), pa.binary()), pa.array(high, pa.int32()), pa.array(low, pa.int32()), pa.array(context, pa.binary()), pa.array([v for _, v in part], pa.list_(pa.int64()))], names=["h", "digest", "high", "low", "context", "at"])

    return texts.mapInArrow(lean(run), GROUPED)


def _starts(rows: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
    """Starts [first, last] by text, those that follow one another as one."""
    by: dict[bytes, list[list[int]]] = {}
    for key, first, last in sorted(rows):
        spans = by.setdefault(key, [])
        if spans and first <= spans[-1][1] + 1:
            spans[-1][1] = max(spans[-1][1], last)
        else:
            spans.append([first, last])
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    return pa.RecordBatch.from_arrays([pa.array(list(by), pa.binary()), pa.array([[{"first": s, "last": e} for s, e in spans] for spans in by.values()], kind)], names=["digest", "spans"])


def _groups(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[list[dict]]:
    """Rows that come sorted by a column, group by group."""
    at, group = None, []
    for batch in batches:
        for i in range(0, len(batch), 1000):
            for row in batch.slice(i, 1000).to_pylist():
                if row[by] != at and group:
                    yield group
                    group = []
                at = row[by]
                group.append(row)
    if group:
        yield group


def _by_suffixes(contexts: DataFrame, length: int, unit: int) -> DataFrame:
    """Repeated starts of the groups, which come sorted by h."""

    def solved(group: list[dict]) -> list[tuple[bytes, int, int]]:
        distinct: dict[tuple, list[dict]] = {}
        for row in group:
            distinct.setdefault((row["high"], row["low"], row["context"]), []).append(row)
        weights = [sum(len(r["at"]) for r in rows) for rows in distinct.values()]
        out = []
        for ranges, rows in zip(repeats(list(distinct), weights, length, unit), distinct.values(), strict=True):
            out.extend((r["digest"], p - t + 1, p - s) for s, t in ranges for r in rows for p in r["at"])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for group in _groups(batches, "h"):
            out.extend(solved(group))
            if len(out) > 10_000:
                yield _starts(out)
                out = []
        yield _starts(out)

    return contexts.mapInArrow(lean(run), STARTS)


WHO = ["h", "high", "low", "context"]
RANGES = "h bigint, high int, low int, context binary, s int, t int"


def _of_large(contexts: DataFrame, length: int, gram: int, unit: int, most: int) -> DataFrame:
    """Repeated starts of groups of any size: equal contexts once, and offsets halved until the groups are small."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "own"):
            rows = [(r["h"], r["high"], r["low"], r["context"], s, t) for r, ranges in zip(group, repeats([(r["high"], r["low"], r["context"]) for r in group], [r["n"] for r in group], length, unit, (group[0]["a"], group[0]["b"])), strict=True) for s, t in ranges]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.int32()), strict=True)], names=[*WHO, "s", "t"])

    rows = contexts.groupBy(*WHO).agg(F.sum(F.size("at")).alias("n"))
    rows = written(rows.select("*", F.lit(0).alias("a"), F.lit(length - gram).alias("b"), F.struct("h", F.lit(b"").alias("shared")).alias("own")), "distinct", 200)
    found = []
    while True:
        sizes = written(rows.groupBy("own").agg(F.count("*").alias("members"), F.sum("n").alias("total")), "sizes", 10_000)
        known = rows.join(sizes.filter("total > 1"), "own")
        small = known.filter(F.col("members") <= most).select(*WHO, "n", "a", "b", "own").repartition("own").sortWithinPartitions("own")
        found.append(written(small.mapInArrow(lean(run), RANGES), "ranges", 200))
        large = known.filter(F.col("members") > most)
        found.append(written(large.filter("a = b").select(*WHO, F.col("a").alias("s"), (F.col("a") + 1).alias("t")), "ranges", 200))
        middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
        halves = F.array(F.struct(F.col("a").alias("a"), middle.alias("b")), F.struct((middle + 1).alias("a"), F.col("b").alias("b")))
        split = large.filter("a < b").select(*WHO, "n", F.explode(halves).alias("half")).select(*WHO, "n", "half.a", "half.b").filter("low <= b AND high >= a")
        # Of a string at an offset from a to b, the bytes around the anchor that it has whatever its offset.
        shared = F.substring("context", (F.col("high") - F.col("a")) * unit + 1, (F.col("a") + length - F.col("b")) * unit)
        rows = written(split.select(*WHO, "n", "a", "b", F.struct("h", F.concat(shared, F.encode(F.concat_ws(",", "a", "b"), "UTF-8")).alias("shared")).alias("own")), "split", 200)
        if rows.isEmpty():
            break
    ranges = found[0]
    for more in found[1:]:
        ranges = ranges.unionByName(more)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, at, spans in zip(*(batch.column(c).to_pylist() for c in ("digest", "at", "spans")), strict=True):
                whole: list[list[int]] = []
                for s, t in sorted((x["s"], x["t"]) for x in spans):
                    if whole and s <= whole[-1][1]:
                        whole[-1][1] = max(whole[-1][1], t)
                    else:
                        whole.append([s, t])
                out.extend((key, p - t + 1, p - s) for s, t in whole for p in at)
            yield _starts(out)

    spans = ranges.groupBy(*WHO).agg(F.collect_list(F.struct("s", "t")).alias("spans"))  # at most one for each offset
    return contexts.join(spans, WHO).select("digest", "at", "spans").mapInArrow(lean(place), STARTS)


def _repeated(rows: DataFrame, length: int, gram: int, unit: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Of rows(digest, text): the texts with a repeated string (digest, text; maybe more), and spans of starts by digest."""
    hashes = written(_anchor_hashes(rows, length, gram, unit), "anchors")
    again = hashes.groupBy("h").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"), F.max("c").alias("c")).filter("lo <> hi OR c > 1").select("h")
    wanted = written(hashes.join(again, "h").groupBy("digest").agg(F.collect_set("h").alias("hs")), "wanted")
    n = wanted.count()
    texts = rows.join(broadcast_if_small(wanted.select("digest"), n), "digest", "left_semi").mapInArrow(lean(_seen_once), rows.schema)
    texts = written(texts.dropDuplicates(["digest"]).join(wanted, "digest"), "texts")
    contexts = written(_contexts(texts, length, gram, unit), "contexts", 200)
    big = written(contexts.groupBy("h").agg(F.count("*").alias("c")).filter(F.col("c") > most).select("h"), "big")
    count = big.count()
    big = broadcast_if_small(big, count, 8)
    small = contexts.join(big, "h", "left_anti").repartition("h").sortWithinPartitions("h")
    starts = _by_suffixes(small, length, unit)
    if count:
        starts = starts.unionByName(_of_large(written(contexts.join(big, "h", "left_semi"), "large", 200), length, gram, unit, most))
    return texts.select("digest", "text"), starts.groupBy("digest").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def union(spans: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the strings whose starts lie in [first, last]."""
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + length)
        else:
            out.append([first, last + length])
    return [(s, e) for s, e in out]


def remove_repeats(docs: DataFrame, length: int = 400, gram: int = 64, most: int = 2000, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(one row for each row of docs: id, n_bytes, n_removed, n_spans, digest, kept_sha256;
    the changed texts: digest, spans, kept (bytes)).
    """
    with scratch(docs.sparkSession, {"listed", "changed"}):
        return _remove_repeats(docs, length, gram, most, id_col, text_col)


def repeated_words(docs: DataFrame, least: int = 50, gram: int = 8, most: int = 2000, text_col: str = "text") -> DataFrame:
    """digest, n_repeated_words: of the texts that have any, the words (runs of no white space) in runs of at least `least` words that also start anywhere else."""
    with scratch(docs.sparkSession, {"repeated"}):
        rows = docs.select(digest(text_col).alias("digest"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        n_words = F.regexp_count("text", F.lit(r"[^ \t-\r]+"))
        copies = rows.groupBy("digest").agg(F.count("*").alias("copies")).filter("copies > 1").select("digest")
        copies = written(copies, "copies", 10_000)
        whole = rows.join(broadcast_if_small(copies, copies.count()), "digest", "left_semi").mapInArrow(lean(_seen_once), rows.schema)
        whole = whole.select("digest", n_words.cast("bigint").alias("n")).filter(F.col("n") >= least).groupBy("digest").agg(F.max("n").alias("n"))
        whole = written(whole, "whole", 200)
        _, spans = _repeated(rows.filter(F.octet_length("text") >= 2 * least - 1), least, gram, 8, most)

        def covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = [sum(e - s for s, e in union([(s["first"], s["last"]) for s in own], least)) for own in batch.column("spans").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(n, pa.int64())], names=["digest", "n"])

        found = whole.unionByName(spans.mapInArrow(lean(covered), "digest binary, n bigint"))
        return written(found.groupBy("digest").agg(F.max("n").alias("n_repeated_words")), "repeated")


def _remove_repeats(docs: DataFrame, length: int, gram: int, most: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), digest(text_col).alias("digest"))
    listed = written(rows.select("id", "digest", F.octet_length("text").cast("bigint").alias("n_bytes")), "listed")
    classes = listed.groupBy("digest").agg(F.count("*").alias("copies"))
    long = rows.filter(F.octet_length("text") >= length).select("digest", "text")
    texts, spans = _repeated(long, length, gram, 1, most)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 500):
                out = []
                for row in batch.slice(i, 500).to_pylist():
                    raw = row["text"].encode()
                    runs = union([(s["first"], s["last"]) for s in row["spans"]], length)
                    edges = [0, *(x for run in runs for x in run), len(raw)]
                    kept = b"".join(raw[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True))
                    out.append((row["digest"], runs, kept, hashlib.sha256(kept).hexdigest()))
                key, runs, kept, hashed = zip(*out, strict=True)
                kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.binary()), pa.array([[{"first": s, "end": e} for s, e in r] for r in runs], kind), pa.array(kept, pa.binary()), pa.array(hashed, pa.string())], names=["digest", "spans", "kept", "kept_sha256"])

    changed = written(texts.join(spans, "digest").mapInArrow(lean(cut), "digest binary, spans array<struct<first:bigint,end:bigint>>, kept binary, kept_sha256 string"), "changed", 200)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["end"] - s["first"])
    found = changed.select("digest", removed.alias("gone"), F.size("spans").cast("bigint").alias("runs"), F.col("kept_sha256").alias("hashed"))
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    out = listed.join(classes.filter("copies > 1"), "digest", "left").join(found, "digest", "left")
    none = F.lit(0).cast("bigint")
    result = out.select(
        "id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("gone", none)).alias("n_removed"),
        F.when(whole, F.lit(1).cast("bigint")).otherwise(F.coalesce("runs", none)).alias("n_spans"),
        "digest",
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("hashed", F.lower(F.hex("digest")))).alias("kept_sha256"),
    )
    return result, changed


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """What repeated 400-byte strings take from every text of documents, and its words in repeated passages of 50 words or more."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    passages = repeated_words(docs)
    found, _ = remove_repeats(docs)
    n = F.coalesce("n_repeated_words", F.lit(0).cast("bigint"))
    both = found.join(passages, "digest", "left")
    return both.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", n.alias("n_repeated_words"), (n > 0).alias("repeats_passage"))
