"""A corpus pipeline: toxic and poor documents go, one of each group of near duplicates stays, the rest is packed.

Each stage takes the documents that the one before kept.  Models are fitted on those documents and on the labels;
the first three stages return the columns of documents, and no others that the input may have.

Defined results: rows with null doc_id or null text are documents like any (in no labelled row; the empty text);
repeated rows are one group of near duplicates; rows that share an id are separate documents; an empty table gives an
empty table.  This module works with the package recordloom.llm only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import packing, quality, simhash, toxicity
from recordloom.llm.shared import small_batches, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs.select(*COLUMNS), model).where("predicted = 0").select(*COLUMNS)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs.select(*COLUMNS), model).where("predicted = 1").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that share five-word shingles at a Jaccard similarity of 0.8 or more, in steps.

    It is that with the smallest doc_id (null after all others), of several such any one.  Rows are told apart by
    numbers of their own, so rows without an id and different texts of one id lose no group.  Texts without a word
    (null ones too) are one group.
    """
    small_batches(spark)
    rows = stored(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "rows")
    found = simhash.similar_groups(rows.select(F.col("row").alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    member = stored(rows.select("row", "doc_id").join(found, "row"), "members")
    keep = member.groupBy("component_id").agg(first).select("first.row")
    gone = stored(member.select("row").join(keep, "row", "left_anti"), "gone")  # few, so the texts need not be shuffled
    return rows.join(F.broadcast(gone) if gone.count() <= simhash.SENT else gone, "row", "left_anti").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("near_duplicates", drop_near_duplicates), ("packing", pack)]

#: No stage but the reading is expressible in SQL; tests/llm/test_pipeline.py holds each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs
