import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402

ITEM = "one two three four five six seven eight nine ten eleven twelve"
LONG = " ".join(f"word{i}" for i in range(40))
NEAR = LONG.replace("word39", "other")
COLUMNS = "doc_id bigint, text string, lang string"


def ran(spark, tmp_path, stage, rows, files=3):
    spark.createDataFrame([(0, ITEM)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(rows, COLUMNS).repartition(files).write.parquet(f"{tmp_path}/documents.parquet")
    out = stage(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert out.columns == ["doc_id", "text", "lang"]
    return sorted(map(tuple, out.collect()), key=str)


def test_exact_dedup_by_row(spark, tmp_path):
    rows = [(1, "a", "x"), (None, "a", "y"), (2, "b", "x"), (2, "b", "x"), (2, "b", "x"), (3, "c", "x"), (3, "d", "x"), (4, "d", "x"), (None, "e", "x"), (None, "e", "x"), (None, None, "x"), (5, "", "x")]
    assert ran(spark, tmp_path, corpus_pipeline.distinct_texts, rows) == sorted([(1, "a", "x"), (2, "b", "x"), (3, "c", "x"), (4, "d", "x"), (None, "e", "x"), (5, "", "x")], key=str)


def test_near_dedup_by_row(spark, tmp_path):
    rows = [(7, LONG, "x"), (None, NEAR, "x"), (7, NEAR, "y"), (8, NEAR, "x"), (8, "alone and apart from all the rest", "x"), (None, "nothing like it is anywhere else here", "x"), (None, None, "x")]
    got = ran(spark, tmp_path, corpus_pipeline.distinct_near, rows)
    assert sum(t in (LONG, NEAR) for _, t, _ in got) == 1
    assert {i for i, t, _ in got if t in (LONG, NEAR)} == {7}
    assert len(got) == 4


def test_decontamination_by_row(spark, tmp_path):
    rows = [(None, f"see {ITEM} end", "x"), (1, f"see {ITEM} end", "x"), (1, "a clean text", "x"), (None, "another clean text", "x"), (2, ITEM, "x"), (2, ITEM, "x")]
    assert ran(spark, tmp_path, corpus_pipeline.uncontaminated, rows) == sorted([(1, "a clean text", "x"), (None, "another clean text", "x")], key=str)


def test_rows_not_read_from_files(spark, tmp_path):
    docs = spark.createDataFrame([(None, "a", "x"), (1, "a", "x"), (1, "a", "x")], COLUMNS)
    assert [tuple(r) for r in corpus_pipeline.distinct_texts(spark, docs, str(tmp_path)).collect()] == [(1, "a", "x")]


def test_a_column_called_score_is_handed_on(spark, tmp_path):
    spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(1, "some good words of a text", "mine", 1), (2, None, None, 2), (3, "more words", "yours", 3)], "doc_id bigint, text string, score string, _score int")
    out = corpus_pipeline.good(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and dict(out.dtypes)["score"] == "string"
    assert {(r.doc_id, r.score, r["_score"]) for r in out.collect()} <= {(1, "mine", 1), (2, None, 2), (3, "yours", 3)}


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
