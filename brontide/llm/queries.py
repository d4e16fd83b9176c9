"""The registered queries of this subpackage; each applies an operator to a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import new_path
from . import language_id, licenses, mixing, ngram_join, packing, token_count, token_files, topk_search, toxicity, vector_dedup
from .linear import fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), window=2048, end_id=1)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0))
    out = toxicity.scored(docs, model)
    return out.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents")).drop("spans")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked(_table(spark, sf_dir, "documents"), n=3, percent=90)


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(_table(spark, sf_dir, "embeddings"), every=50, k=5)


def op6_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.93)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(fold(F.col("doc_id"), 4) != 2))
    out = language_id.identified(docs, model)
    return out.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(_table(spark, sf_dir, "documents"), weights=(1, 2, 3), most=3.0)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.token_digests(token_files.read_token_files(spark, path))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_table(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


QUERIES = {f.__name__: f for f in (op1_packing, op2_toxicity, op3_license_scan, op4_ngram_join, op5_topk_search, op6_vector_dedup, op7_language_id, op8_mixing, op9_token_files, op10_token_counts)}
ORACLE_SQL = {"op3_license_scan": licenses.oracle_sql(), "op4_ngram_join": ngram_join.oracle_sql(3, 90), "op5_topk_search": topk_search.ORACLE, "op6_vector_dedup": vector_dedup.ORACLE, "op8_mixing": mixing.ORACLE}
