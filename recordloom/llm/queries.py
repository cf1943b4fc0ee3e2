"""The registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, licences, packing, quality, quality_rules, rans, simhash, token_counts, topk, toxicity
from .shared import small_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").where("quality = 1")
    return quality_rules.judge(_table(spark, sf_dir, "documents"), labels)


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return rans.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.with_limit(token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.with_hex(simhash.near_duplicates(_table(spark, sf_dir, "documents")))


OP1_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q, usable c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""


def queries() -> dict:
    return {
        "op1_topk": op1_topk,
        "op2_bpe": op2_bpe,
        "op3_toxicity": op3_toxicity,
        "op4_quality": op4_quality,
        "op5_quality_rules": op5_quality_rules,
        "op6_licences": op6_licences,
        "op7_packing": op7_packing,
        "op8_token_files": op8_token_files,
        "op9_token_counts": op9_token_counts,
        "op10_simhash": op10_simhash,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_topk": OP1_SQL}
