"""A corpus pipeline over documents: five stages, each written and read again as the next one's docs.

quality classifier -> exact dedup -> near-duplicate dedup -> benchmark decontamination -> BPE.
Each stage but the last returns the columns of documents for the rows it keeps. Rows are judged one by one, by file and
place in the file: a row without a doc_id, or one that shares it, goes or stays like any other. Of equal texts and of
near duplicates one row stays; one without a doc_id only if no other has any. See the operators for further cases.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sendero.llm import bpe, decontaminate, exact_dedup, ngram_join, quality
from sendero.llm._common import BATCH, broadcast_if_small, written

ROWS = 1000  # texts that go to a Python worker at a time; a stage's result is written only after it has returned
ROW = "_row"


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    spark.conf.set(BATCH, ROWS)
    net = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    columns, own = docs.columns, "_score"
    while own.lower() in (c.lower() for c in columns):
        own += "_"
    return quality.score(docs, net, out=own).filter(F.col(own) >= quality.ACCEPT).select(*columns)


def keyed(docs: DataFrame) -> DataFrame:
    """docs with ROW, a number of each row that is the same whenever it is read: its file's, and its place in there."""
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at")]
    try:
        placed = docs.select("*", *place)
    except AnalysisException:  # not read from files
        placed = (docs := written(docs, "docs")).select("*", *place)
    files = sorted(r[0] for r in placed.select("_file").distinct().collect())
    numbers = docs.sparkSession.createDataFrame(pa.table({"_file": pa.array(files, pa.string()), "_number": pa.array(range(len(files)), pa.int64())}))
    return placed.join(F.broadcast(numbers), "_file").select(*docs.columns, (F.col("_number") * (1 << 36) + F.col("_at")).alias(ROW))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """keyed docs without the rows in gone(ROW), and without the key."""
    gone = written(gone, "gone")
    return docs.join(broadcast_if_small(gone, gone.count(), 16), ROW, "left_anti").drop(ROW)


def _others(docs: DataFrame, grouped: DataFrame, stays: Column) -> DataFrame:
    """The rows of grouped(ROW, group) but the one of each group that stays, an extreme of structs that hold ROW."""
    members = written(grouped.join(docs.select(ROW, F.col("doc_id").cast("bigint").alias("doc_id")), ROW), "members", 10_000)
    stay = members.groupBy("group").agg(stays.alias("stay")).select(F.col("stay")[ROW].alias(ROW))
    return members.join(stay, ROW, "left_anti").select(ROW)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that of the largest doc_id."""
    rows = keyed(docs)
    found = exact_dedup.exact_dedup(rows, keep="largest", id_col=ROW).filter("group_size > 1")
    return _without(rows, _others(rows, found.select(F.col("id").alias(ROW), F.col("keep_id").alias("group")), F.max(F.struct("doc_id", ROW))))


def distinct_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates (five words, similarity 0.8), that of the smallest doc_id."""
    rows = keyed(docs)
    found = ngram_join.near_duplicates(rows, k=5, num=4, den=5, id_col=ROW)
    grouped = found.select(F.col("id").alias(ROW), F.coalesce("component_id", "id").alias("group"))
    return _without(rows, _others(rows, grouped, F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW))))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the rows that hold a passage of the benchmark."""
    rows = keyed(docs)
    found = decontaminate.contamination(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=ROW)
    return _without(rows, found.filter(F.size("spans") > 0).select(F.col("id").alias(ROW)))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the text decoded from them."""
    spark.conf.set(BATCH, ROWS)
    return bpe.round_trip(docs).withColumnRenamed("id", "doc_id")


STAGES = [("quality", good), ("exact_dedup", distinct_texts), ("near_dedup", distinct_near), ("decontaminate", uncontaminated), ("bpe", encoded)]
#: The trained network and the tokenizer are beyond SQL; tests/llm/test_pipeline.py holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each but the last returns is written in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
