import random

import pytest

from sendero.llm import quality


def made(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    docs, labels = [], []
    for i in range(400):
        text = " ".join(word() for _ in range(rng.randrange(5, 300)))
        if i % 2:
            text = text.upper().replace(" ", "!! ")
        docs.append((i, text, i % 2 == 0))
        labels.append((i, int(i % 2 == 0)))
    docs += [(None, None, True), (3, "", True), (401, "x" * 100_000, True)]
    return spark.createDataFrame(docs, "doc_id bigint, text string, id boolean"), spark.createDataFrame([*labels, (9999, 1), (5, None)], "doc_id bigint, quality int")


def test_held_out_accuracy(spark):
    docs, labels = made(spark)
    net = quality.train(docs, labels, epochs=12)
    rows = quality.score(docs, net).withColumn("held", quality.held_out("doc_id")).collect()
    assert len(rows) == 403 and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held and r.text and r.doc_id < 400]
    assert len(held) > 40
    assert sum((r.score >= 0.5) == (r.doc_id % 2 == 0) for r in held) >= 0.97 * len(held)
    again = {(r.doc_id, r.text): r.score for r in quality.score(docs, quality.train(docs, labels, epochs=12)).collect()}
    assert all(again[r.doc_id, r.text] == r.score for r in rows)


def test_no_labels(spark):
    docs, labels = made(spark)
    assert {r.score for r in quality.score(docs, quality.train(docs, labels.limit(0))).collect()} == {0.5}
    assert quality.score(docs.limit(0), None).count() == 0


def test_training_reads_whole_texts(spark, monkeypatch):
    long = "good words " * 3000 + "a bad passage " + "good words " * 3000
    docs = spark.createDataFrame([(i, long + str(i)) for i in range(8)] + [(8, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(9)], "doc_id bigint, quality int, toxic int")
    seen = {}
    monkeypatch.setattr(quality, "fit", lambda texts, labels, **how: seen.update(zip(texts, labels, strict=True)))
    quality.train(docs, labels)
    used = [r.doc_id for r in docs.filter(~quality.held_out("doc_id")).collect()]
    assert used and seen == {b"" if i == 8 else f"{long}{i}".encode(): i % 2 for i in used}


def test_a_column_called_score_stays(spark):
    docs = spark.createDataFrame([(1, "good words", "mine", 0.5), (2, None, None, None)], "doc_id bigint, text string, score string, Own double")
    with pytest.raises(ValueError, match="score"):
        quality.score(docs, None)
    with pytest.raises(ValueError, match="own"):
        quality.score(docs, None, out="own")
    out = quality.score(docs, None, out="p")
    assert out.columns == [*docs.columns, "p"] and sorted(((r.doc_id, r.score, r.p) for r in out.collect())) == [(1, "mine", 0.5), (2, None, 0.5)]
