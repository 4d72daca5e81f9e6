import hashlib
import random
import re
from collections import Counter

import pytest

from sendero.llm import suffix_dedup as sd


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = [False] * len(r)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        out.append((len(r), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    letters = lambda n: "".join(rng.choice("abñ ") for _ in range(n))
    hot, other = letters(55), letters(120)
    texts = [None, "", "a", "x" * 500, "ab" * 200 + letters(30), letters(39), letters(40), hot, hot]
    for _ in range(80):
        t = letters(rng.randrange(150))
        if rng.random() < 0.6:
            t += hot[rng.randrange(10) : 40 + rng.randrange(16)] + letters(rng.randrange(60))
        if rng.random() < 0.3:
            k = rng.randrange(100)
            t = other[:k] + letters(1) + other[k:] + t
        if rng.random() < 0.1:
            t += t[:60]
        texts.append(t)
    return texts + texts[20:24]


def test_sorting():
    rng = random.Random(1)
    for n in (1, 2, 3, 50, 400):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(3))) + b"c" * rng.choice([0, 40, 41, 90]) + bytes(rng.choice(b"ab") for _ in range(rng.randrange(6))) for _ in range(n)]
        assert [texts[i] for i in sd.deep_shallow(texts)] == sorted(texts)
        assert [texts[i] for i in sd.blind_trie(texts, list(range(n)))] == sorted(texts)
        assert sorted(sd.deep_shallow(texts)) == list(range(n))


@pytest.mark.parametrize(("most", "seed"), [(20_000, 1), (3, 2), (1, 3)])
def test_against_brute_force(spark, most, seed):
    for seed in (seed,):
        texts = corpus(seed)
        docs = spark.createDataFrame([(i if i % 9 else 7, t, i) for i, t in enumerate(texts)], "doc_id bigint, text string, digest int").repartition(4)
        found, changed = sd.remove_repeats(docs, length=40, gram=8, most=most)
        got = sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect())
        assert got == sorted(brute(texts, 40))
        assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in changed.collect())


def test_parts_of_a_long_text(monkeypatch, spark):
    monkeypatch.setattr(sd, "PART", 64)
    texts = corpus(3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    anchors = [(base + p, base + s, base + e, h) for base, *cols in sd.text_anchors(__import__("numpy").frombuffer(texts[-1].encode() * 9, "uint8"), 40, 8) for p, s, e, h in zip(*cols, strict=True)]
    starts = [i for _, s, e, _ in anchors for i in range(s, e + 1)]
    assert starts == list(range(len(texts[-1].encode()) * 9 - 39))
    assert sd.remove_repeats(docs.limit(0), 40, 8)[0].count() == 0


@pytest.mark.parametrize("most", [2000, 1])
def test_repeated_words(spark, most):
    rng = random.Random(8)
    some = lambda n: [rng.choice(["a", "b", "ñandú", "C"]) + rng.choice("xyz") * rng.randrange(3) for _ in range(n)]
    passage, texts = some(14), [None, "", " ", "a " * 30, "one two"]
    for _ in range(70):
        t = some(rng.randrange(40))
        if rng.random() < 0.6:
            at = rng.randrange(len(t) + 1)
            t[at:at] = passage[rng.randrange(3) : rng.randrange(8, 15)]
        texts.append(rng.choice([" ", "\n", " \t"]).join(t))
    texts += texts[9:12]
    lists = [re.findall(r"[^ \t-\r]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + 10]) for w in lists for i in range(len(w) - 9))
    want = []
    for w in lists:
        gone = {j for i in range(len(w) - 9) if seen[tuple(w[i : i + 10])] > 1 for j in range(i, i + 10)}
        want.append(len(gone))
    docs = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "text string, digest int").repartition(4)
    n = {bytes(r.digest): r.n_repeated_words for r in sd.repeated_words(docs, least=10, gram=3, most=most).collect()}
    assert [n.get(hashlib.sha256((t or "").encode()).digest(), 0) for t in texts] == want
    assert sd.repeated_words(docs.limit(0)).count() == 0
