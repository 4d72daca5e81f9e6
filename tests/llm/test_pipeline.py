import hashlib
import random

import pytest

pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from sendero.llm import bpe, quality  # noqa: E402
from tests.llm.test_ngram_join import brute, sets_of  # noqa: E402


def test_stages_against_plain_python(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7)))
    texts = [" ".join(word() for _ in range(rng.randrange(8, 120))) for _ in range(300)]
    items = [" ".join(word() for _ in range(14)) for _ in range(5)]
    for i in range(0, 300, 3):
        texts[i] = texts[i].upper().replace(" ", "!! ")
    for i in range(1, 300, 17):
        texts[i] = texts[(i + 4) // 3 * 3 - 1]
    for i in range(4, 300, 21):
        texts[i] = texts[i] + " " + items[i % 5] + " end"
    for i in range(7, 300, 30):
        w = texts[i - 2].split()
        texts[i] = " ".join([*w[:-1], "changed"])
    rows = list(enumerate(texts))
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows] + [(None, None, None, None, None)], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(300)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    net = quality.train(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    kept = {r.doc_id: r.text for r in quality.score(docs, net).filter("score >= 0.3").collect() if r.doc_id is not None}
    by_text = {}
    for i, t in kept.items():
        by_text[t] = max(i, by_text.get(t, -1))
    rows = sorted((i, t) for t, i in by_text.items())
    alive = [(i, dict(rows)[i]) for i, _, c in brute(rows, 5, 4, 5) if i == c]
    bad = set().union(*(sets_of(x, 10) for x in items))
    alive = [(i, t) for i, t in alive if not sets_of(t, 10) & bad]
    lib = Tokenizer.from_file(bpe.default_path())
    want = sorted((i, len(lib.encode(t, add_special_tokens=False).ids), hashlib.sha256(t.encode()).hexdigest()) for i, t in alive)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in out if r.doc_id is not None) == want
    assert 100 < len(want) < 200
