"""Benchmark decontamination by winnowing.

Words are runs of ASCII letters and digits and of any other characters beyond ASCII, A-Z lower-cased. Of every window
of `span - gram + 1` consecutive gram-word hashes the least is kept, in documents and in items alike, so each run of
`span` words that both share leaves the same fingerprint in both. Fingerprints are joined, and each hit is extended
word by word; a run of at least `span` equal words counts. An item of fewer words than span is one window of its own
length and is looked up whole.

Documents emit only fingerprints that pass a bitmap of fixed size (512 KB) over the item fingerprints, so what is
shuffled follows the hits. The join is an ordinary equi-join: Spark broadcasts the items where a count has shown that
they are small and shuffles them otherwise.

Defined cases: a null or empty text has no words and no hits; null and repeated items are allowed (a null item_id is
not listed, its words still count as hit); each input row gives one row, also where doc_id is null or repeated; other
columns are ignored; with an empty benchmark nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sendero.llm._common import ALNUM, U64, broadcast_if_small, lean, lowered, mixed, pieces, prefix_sums, shingles, span_hashes, strings, words, written

MASK = (1 << 22) - 1


def winnowed(word_hash: np.ndarray, first: np.ndarray, gram: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the kept grams; first: index of each text's first word (n+1)."""
    grams = shingles(word_hash, gram)
    windows = len(word_hash) - span + 1
    if windows <= 0:
        return np.zeros(0, np.int64), grams[:0]
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = text[:windows] == text[span - 1 :]
    width = span - gram + 1
    least = grams[:windows].copy()
    for t in range(1, width):
        np.minimum(least, grams[t : t + windows], out=least)
    kept = np.zeros(len(grams), bool)
    for t in range(width):
        kept[t : t + windows] |= whole & (grams[t : t + windows] == least)
    at = np.flatnonzero(kept)
    return at, grams[at]


def fingerprints(data: np.ndarray, offsets: np.ndarray, gram: int, span: int, short: list[int]) -> tuple[np.ndarray, tuple, tuple]:
    """(words of each text), (start, end, first), (text, position, gram length, hash) of all kept fingerprints."""
    start, end, first = words(data, offsets, ALNUM)
    own = span_hashes(prefix_sums(data), start, end)
    at, found = winnowed(own, first, gram, span)
    parts = [(at, np.full(len(at), gram), found ^ mixed(np.full(1, gram * 64 + span, U64)))]
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for m in short:
        grams = shingles(own, m)
        at = np.flatnonzero(text[: len(grams)] == text[m - 1 :])
        parts.append((at, np.full(len(at), m), grams[at] ^ mixed(np.full(1, m * 64 + m, U64))))
    at, size, found = (np.concatenate(x) for x in zip(*parts, strict=True))
    return np.diff(first), (start, end, first), (text[at], at, size, found)


def _context(low: bytes, start: np.ndarray, end: np.ndarray, lo: int, hi: int) -> str:
    return " ".join(low[s:e].decode() for s, e in zip(start[lo:hi].tolist(), end[lo:hi].tolist(), strict=True))


OUT = "rid bigint, id bigint, n_words bigint, at bigint, size int, h bigint, before int, context string"


def _scan(rows: DataFrame, gram: int, span: int, short: list[int], seen: bytes | None, item: bool) -> DataFrame:
    """Fingerprints of rows(rid, id, text) with the words around them; a row without any gives one without context."""
    around = span - gram

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if seen is None else np.frombuffer(seen, np.uint8)
        for batch in batches:
            data, offsets = strings(batch.column("text"))
            rids, ids = batch.column("rid").to_numpy(), batch.column("id").to_pylist()
            for a, b in pieces(offsets):
                low = lowered(data[offsets[a] : offsets[b]])
                n_words, (start, end, first), (text, at, size, found) = fingerprints(low, offsets[a : b + 1] - offsets[a], gram, span, short)
                if item:  # an item of fewer words than a span is one window
                    keep = np.where(n_words[text] < span, size == n_words[text], size == gram) & ((size == gram) | (n_words[text] < span))
                    keep &= ~((n_words[text] < span) & (at != first[:-1][text]))
                else:
                    keep = np.ones(len(at), bool)
                if bits is not None:
                    low_bits = found & U64(MASK)
                    keep &= (bits[(low_bits >> U64(3)).astype(np.int64)] >> (low_bits & U64(7)).astype(np.uint8)) & 1 > 0
                text, at, size, found = text[keep], at[keep], size[keep], found[keep]
                raw, cols = low.tobytes() if len(at) else b"", [[] for _ in range(8)]
                for t, p, k, h in zip(text.tolist(), at.tolist(), size.tolist(), found.view(np.int64).tolist(), strict=True):
                    f, last = int(first[t]), int(first[t + 1])
                    lo, hi = (max(f, p - around), min(last, p + k + around)) if k == gram and not (k in short and n_words[t] == k and item) else (p, p + k)
                    for col, x in zip(cols, (int(rids[a + t]), ids[a + t], int(n_words[t]), p - f, k, h, p - lo, _context(raw, start, end, lo, hi)), strict=True):
                        col.append(x)
                for t in np.setdiff1d(np.arange(b - a), text).tolist() if not item else ():
                    for col, x in zip(cols, (int(rids[a + t]), ids[a + t], int(n_words[t]), -1, 0, int(mixed(np.array([rids[a + t]], U64)).view(np.int64)[0]), 0, None), strict=True):
                        col.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.string()), strict=True)], names=["rid", "id", "n_words", "at", "size", "h", "before", "context"])

    return rows.mapInArrow(lean(scan), OUT)


def extended(context: str, before: int, other: str, other_before: int, size: int) -> tuple[int, int]:
    """Words before and from the gram's start that both contexts share around it; (0, 0) if the gram itself differs."""
    x, y = context.split(" "), other.split(" ")
    if x[before : before + size] != y[other_before : other_before + size]:
        return 0, 0
    left = 0
    while left < min(before, other_before) and x[before - left - 1] == y[other_before - left - 1]:
        left += 1
    right = size
    while right < min(len(x) - before, len(y) - other_before) and x[before + right] == y[other_before + right]:
        right += 1
    return left, right


def _verified(pairs: DataFrame, gram: int, span: int) -> DataFrame:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo, hi, item = [], [], []
            for at, size, context, before, other, other_before, whole, i in zip(*(batch.column(c).to_pylist() for c in ("at", "size", "context", "before", "other", "other_before", "whole", "item_id")), strict=True):
                left, right = (0, 0) if context is None or other is None else extended(context, before, other, other_before, size)
                hit = right > 0 and (whole or left + right >= span)
                lo.append(at - left if hit else None)
                hi.append(at + right if hit else None)
                item.append(i if hit else None)
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("id"), batch.column("n_words"), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(item, pa.int64())], names=["rid", "id", "n_words", "lo", "hi", "item_id"])

    return pairs.mapInArrow(lean(verify), "rid bigint, id bigint, n_words bigint, lo bigint, hi bigint, item_id bigint")


def contamination(docs: DataFrame, items: DataFrame, gram: int = 5, span: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each row of docs: rid, id, n_words, spans (disjoint or not, [lo, hi) in words), items (ids)."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    tests = items.select(F.monotonically_increasing_id().alias("rid"), F.col(item_col).cast("bigint").alias("id"), F.col(item_text).alias("text"))
    prints = _scan(tests, gram, span, list(range(1, span)), None, True).select("h", F.col("id").alias("item_id"), F.col("size").alias("item_size"), F.col("context").alias("other"), F.col("before").alias("other_before"), (F.col("n_words") < span).alias("whole")).distinct().persist()
    try:
        about = prints.agg(F.count("*").alias("n"), F.collect_set(F.when(F.col("whole"), F.col("item_size"))).alias("short")).first()
        low = prints.select(F.col("h").bitwiseAND(MASK).alias("x"))
        marks = low.groupBy(F.expr("shiftright(x, 6)").alias("w")).agg(F.expr("bit_or(shiftleft(1L, CAST(x & 63 AS INT)))").alias("bits")).collect()  # (MASK + 1) / 64 rows at most
    finally:
        prints.unpersist()
    bits = np.zeros((MASK + 1) // 64, "<i8")
    bits[[r["w"] for r in marks]] = [r["bits"] for r in marks]
    # Written, so that no task holds the Python workers of both steps.
    found = written(_scan(rows, gram, span, sorted(about["short"]), bits.tobytes(), False), "fingerprints")
    pairs = found.join(broadcast_if_small(prints, about["n"], 256), (found["h"] == prints["h"]) & (found["size"] == prints["item_size"]), "left").drop(prints["h"])
    hits = _verified(pairs, gram, span)
    return hits.groupBy("rid").agg(F.max("id").alias("id"), F.max("n_words").alias("n_words"), F.collect_set(F.when(F.col("lo").isNotNull(), F.struct("lo", "hi"))).alias("spans"), F.collect_set("item_id").alias("items"))


def covered(spans: str = "spans") -> F.Column:
    """Words inside the union of the spans."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))
    step = lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0).cast("bigint"), s["hi"] - F.greatest(s["lo"], acc["end"]))).alias("n"), F.greatest(acc["end"], s["hi"]).alias("end"))
    return F.aggregate(F.array_sort(spans), start, step, lambda acc: acc["n"])


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Words of documents inside passages of benchmark."""
    found = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    listed = F.concat_ws(",", F.array_sort(F.transform("items", lambda x: x.cast("string"))))
    out = found.select(F.col("id").alias("doc_id"), "n_words", covered().alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"))
    return out.withColumn("contaminated", F.col("n_hit") > 0)


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, p, k, array_to_string(w[p : p + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)
), h AS (
  SELECT doc_id, p, dw.k, item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.k = iw.k
), hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM h) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS listed FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
