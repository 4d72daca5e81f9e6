"""Quality classifier: a byte-level convolutional network in numpy.

A text is laid out in blocks of BLOCK bytes, padded with zeros. Learned filters of WIDTH bytes run over it with stride
STRIDE; chunks of CHUNK blocks, each overlapping the next by one, cover the whole text. Filter responses are
max-pooled in each chunk; the mean and the maximum over the chunks feed a small dense layer and one logistic output.
A filter is a table of weights by byte and offset, so a response is WIDTH table rows added up.

Training: at most `per_class` labelled rows of each class (those of least hash) whose crc32(doc_id) mod 5 is not 0, with
every byte of their texts, and about SHORT short beginnings of those of label 1, which short clean texts resemble; Adam with a fixed seed. Scoring reads every byte of every text.

Defined cases: a null or empty text is one block of zeros and gets a score; null or repeated ids give rows of their
own (a null id is not held out); labels without a document are ignored; other columns are ignored; with no usable label of one of
the classes every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sendero.llm._common import broadcast_if_small, pieces, strings, trim

WIDTH, STRIDE, BLOCK, CHUNK = 6, 2, 64, 8
FILTERS, HIDDEN = 24, 16
ACCEPT = 0.3
PIECE = 1 << 18  # bytes of texts scored together
SHORT = 500  # beginnings of sample texts of label 1, added to the sample as short texts of label 1


def blocks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts laid out from block starts with at least WIDTH zeros after each, and the first block of each text (n+1)."""
    size = np.diff(offsets)
    count = (size + WIDTH + BLOCK - 1) // BLOCK
    first = np.concatenate(([0], np.cumsum(count)))
    out = np.zeros(int(first[-1]) * BLOCK + WIDTH, np.uint8)
    out[np.repeat(first[:-1] * BLOCK - (offsets[:-1] - offsets[0]), size) + np.arange(int(size.sum()))] = data[offsets[0] : offsets[-1]]
    return out, first


def chunk_starts(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and end block of all chunks, and the first chunk of each text (n+1)."""
    count = np.diff(first)
    chunks = np.maximum(1, -(-(count - 1) // (CHUNK - 1)))
    at = np.concatenate(([0], np.cumsum(chunks)))
    text = np.repeat(np.arange(len(count)), chunks)
    start = first[text] + (np.arange(at[-1]) - at[text]) * (CHUNK - 1)
    return start, np.minimum(start + CHUNK, first[text + 1]), at


class ByteNet:
    def __init__(self, rng: np.random.Generator) -> None:
        self.table = rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.w1 = rng.normal(0, 0.3, (2 * FILTERS, HIDDEN)).astype(np.float32)
        self.b1 = np.zeros(HIDDEN, np.float32)
        self.w2 = rng.normal(0, 0.3, HIDDEN).astype(np.float32)
        self.b2 = np.zeros(1, np.float32)

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Filter responses at every STRIDE-th byte of laid-out texts."""
        n = len(data) - WIDTH
        out = self.table[0].take(data[0:n:STRIDE], axis=0)
        for k in range(1, WIDTH):
            out += self.table[k].take(data[k : k + n : STRIDE], axis=0)
        return out

    def pooled(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean and maximum over the chunks of each text, of the chunk maxima."""
        parts = [self.responses(data[i * BLOCK : min(len(data), (i + 1024) * BLOCK + WIDTH)]).reshape(-1, BLOCK // STRIDE, FILTERS).max(axis=1) for i in range(0, int(first[-1]), 1024)]
        best = np.concatenate(parts)
        start, end, at = chunk_starts(first)
        top = best[start]
        for k in range(1, CHUNK):
            np.maximum(top, best[np.minimum(start + k, end - 1)], out=top)
        top = np.maximum(top + self.bias, 0)
        return np.add.reduceat(top, at[:-1]) / np.diff(at)[:, None].astype(np.float32), np.maximum.reduceat(top, at[:-1])

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probabilities of label 1."""
        hidden = np.maximum(np.hstack(self.pooled(*blocks(data, offsets))) @ self.w1 + self.b1, 0)
        return 1 / (1 + np.exp(-np.clip(hidden @ self.w2 + self.b2, -30, 30).astype(np.float64)))

    def params(self) -> list[np.ndarray]:
        return [self.table, self.bias, self.w1, self.b1, self.w2, self.b2]

    def gradients(self, data: np.ndarray, offsets: np.ndarray, label: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Of the weighted logistic loss."""
        laid, first = blocks(data, offsets)
        per = BLOCK // STRIDE
        shaped = self.responses(laid).reshape(-1, per, FILTERS)
        where = shaped.argmax(axis=1)
        best = np.take_along_axis(shaped, where[:, None, :], 1)[:, 0]
        start, end, at = chunk_starts(first)
        stacked = np.stack([best[np.minimum(start + k, end - 1)] for k in range(CHUNK)])
        which = stacked.argmax(axis=0)
        raw = np.take_along_axis(stacked, which[None], 0)[0] + self.bias
        top = np.maximum(raw, 0)
        text = np.repeat(np.arange(len(first) - 1), np.diff(at))
        chunks = np.diff(at)[:, None].astype(np.float32)
        high = np.maximum.reduceat(top, at[:-1])
        x = np.hstack([np.add.reduceat(top, at[:-1]) / chunks, high])
        pre = x @ self.w1 + self.b1
        hidden = np.maximum(pre, 0)
        p = 1 / (1 + np.exp(-np.clip(hidden @ self.w2 + self.b2, -30, 30)))
        d = ((p - label) * weight / weight.sum()).astype(np.float32)
        dh = d[:, None] * self.w2 * (pre > 0)
        dx = dh @ self.w1.T
        is_high = top == high[text]
        ties = np.add.reduceat(is_high.astype(np.float32), at[:-1])
        dtop = (dx[:, :FILTERS] / chunks)[text] + (dx[:, FILTERS:] / ties)[text] * is_high
        dtop *= raw > 0
        block = np.minimum(start[:, None] + which, end[:, None] - 1)
        position = (block * per + np.take_along_axis(where, block, 0)) * STRIDE
        grad = np.empty_like(self.table)
        f = np.arange(FILTERS)
        for k in range(WIDTH):
            grad[k] = np.bincount((laid[position + k].astype(np.int64) * FILTERS + f).ravel(), dtop.ravel(), 256 * FILTERS).reshape(256, FILTERS)
        return [grad, dtop.sum(axis=0), x.T @ dh, dh.sum(axis=0), hidden.T @ d, d.sum(keepdims=True)]


def fit(texts: list[bytes], labels: list[int], epochs: int = 16, batch: int = 64, rate: float = 0.01, decay: float = 1e-4, seed: int = 5) -> ByteNet | None:
    """Train on the texts, both classes weighing the same; None if a class is missing."""
    if len(set(labels)) < 2:
        return None
    rng = np.random.default_rng(seed)
    good = [t for t, label in zip(texts, labels, strict=True) if label == 1]
    short = [t[: int(rng.integers(15, 90))].rsplit(b" ", 1)[0] for t in good[:: max(1, len(good) // SHORT)]]
    texts, labels = [*texts, *short], [*labels, *[1] * len(short)]
    y = np.array(labels, np.float32)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    net = ByteNet(rng)
    first, second, step = [np.zeros_like(p) for p in net.params()], [np.zeros_like(p) for p in net.params()], 0
    total = epochs * -(-len(y) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for a in range(0, len(y), batch):
            own = order[a : a + batch]
            raw = [texts[i] for i in own]
            grads = net.gradients(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))), y[own], weight[own])
            step += 1
            now = rate * (1 - step / (total + 1))
            for p, g, m, v in zip(net.params(), grads, first, second, strict=True):
                g = g + decay * p
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def held_out(id_col: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1500, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **how: float) -> ByteNet | None:
    """Fit on a bounded sample of the labelled rows that are not held out."""
    own = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    order = [F.xxhash64("id"), F.col("id")]
    sample = [r for c in (0, 1) for r in own.filter(F.col("label") == c).dropDuplicates(["id"]).orderBy(*order).limit(per_class).collect()]
    if not sample:
        return None
    chosen = docs.sparkSession.createDataFrame([(r.id, r.label) for r in sample], "id bigint, label int")

    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    found = texts.join(broadcast_if_small(chosen, len(sample), 32), "id").select("id", "text", "label")
    rows = sorted({(r.id, bytes(r.text), r.label) for r in found.collect()})
    return fit([r[1] for r in rows], [r[2] for r in rows], **how)


def score(docs: DataFrame, net: ByteNet | None, text_col: str = "text", out: str = "score") -> DataFrame:
    """docs with the column `out`, 0 to 1: how likely label 1 is. Every column of docs is kept, so `out` must be a new name."""
    if out.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"docs has a column {out} already")

    @F.arrow_udf(DoubleType())
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            data, offsets = strings(texts)
            parts = [np.full(b - a, 0.5) if net is None else net.scores(data, offsets[a : b + 1]) for a, b in pieces(offsets, PIECE)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())
        trim()

    return docs.withColumn(out, of(F.col(text_col)))


def op4_quality(spark, sf_dir: str) -> DataFrame:
    """The quality score of every text of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    net = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, net).select("doc_id", held_out("doc_id").alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))
