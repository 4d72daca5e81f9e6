import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from sendero.llm import bpe  # noqa: E402

CASES = ["", " ", "  ", "a", " a", "  a  b", "don't they'll we've I'm he'd it's 'sx 's ''s x''s", "a\n\n b\r\n", " x   y", "naïve Ñandú 東京 ١٢٣ ½", "x<|endoftext|> y <|endoftext|><|endoftext|>", "it'sself 'll'll 're's", "é ​ ﻿", "a" * 5000, "!!! ??'s \"'s", "\x00\x01 \t\tz", "😀😀 👩‍👩‍👧", "<|endoftext|", "'s'"]


@pytest.fixture(scope="module")
def both():
    path = bpe.default_path()
    return bpe.ByteBPE(path), Tokenizer.from_file(path)


def encoded(own, texts):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    ids, at = own.encode(data, offsets)
    text, cut = own.decode(ids, at)
    return [ids[s:e].tolist() for s, e in zip(at[:-1], at[1:], strict=True)], [text[s:e].tobytes() for s, e in zip(cut[:-1], cut[1:], strict=True)]


def test_same_ids_as_the_library(both):
    own, lib = both
    rng = random.Random(7)
    some = ["".join(rng.choice("ab 'sStTvlremd.\n\t 1é東 !<|>") for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts = CASES + some
    ids, back = encoded(own, texts)
    for text, got, raw in zip(texts, ids, back, strict=True):
        assert got == lib.encode(text, add_special_tokens=False).ids, repr(text)
        assert raw == text.encode()


def test_frames(spark, both):
    rows = [(1, "Hello world"), (None, None), (1, ""), (1, "Hello world"), (9, "x" * 20000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = bpe.round_trip(docs).collect()
    assert len(out) == 5 and sorted(r.n_tokens for r in out)[:2] == [0, 0]
    texts = {(r.id, r.text) for r in bpe.decode(bpe.encode(docs)).collect()}
    assert texts == {(i, t or "") for i, t in rows}
    assert bpe.round_trip(docs.limit(0)).count() == 0


def test_other_columns_may_have_any_name(spark):
    rows = [(1, "Hello world", 5, "x", 7), (2, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, id int, ids_sha256 string, n_tokens int")
    plain = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    assert sorted(map(tuple, bpe.round_trip(docs).collect())) == sorted(map(tuple, bpe.round_trip(plain).collect()))
    assert sorted((r.id, list(r.ids)) for r in bpe.encode(docs).collect()) == sorted((r.id, list(r.ids)) for r in bpe.encode(plain).collect())
