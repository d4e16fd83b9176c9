"""The corpus pipeline: five stages over ``documents``, each one operator of ``brontide.llm``.

1. toxicity: documents that the segment model calls toxic go.
2. language: documents without a recognisable language go (no letter at all, or no language that
   is likelier than chance by 4 %, whatever the number of learned languages); every other document stays,
   and one in a language that was not learned can stay too, since its score is seldom that near to chance.
3. near duplicates: of each component of documents that share 0.8 or more of their five-word
   shingles, the one row with the smallest doc_id stays. Rows are told apart by a key of their own: of
   rows that share a doc_id or have none, each is judged by its text, and of repeated rows one stays
   (which one is of no account, except that a row with an id goes before one without). Documents too
   short for one word stay.
4. mixing: documents stay, go or are repeated so that sources come near their target weights.
5. packing: pieces of at most 2048 tokens with their place in a sequence.

All stages but the last return the columns of ``documents``. ORACLE_SQL is None: the two models and
the packing cannot be written in SQL; tests/llm holds brute-force versions.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brontide.llm import language_id, mixing, ngram_join, packing, toxicity
from brontide.sources.scratch import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A language is recognised if its probability is at least this with four languages, which at random have 0.25.
LEAST_LANGUAGE = 0.26


def least_language(languages: int) -> float:
    """The same margin over chance (4 %) for any number of learned languages; a single one has nothing to be likelier than."""
    return min(1.0, LEAST_LANGUAGE * 4 / max(1, languages))


def _row_and_text(docs: DataFrame) -> DataFrame:
    """Each row whole as ``row``, with what the operators read beside it."""
    return docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs["text"].alias("text"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(_row_and_text(docs), model, keep=("row",)).where("predicted = 0").select("row.*")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(docs)
    found = language_id.identified(_row_and_text(docs), model, keep=("row",))
    return found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= least_language(len(model.languages)))).select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # written, so that a row has the same key each time it is read
    keyed = staged(_row_and_text(docs).withColumn("key", F.monotonically_increasing_id()), "keyed")
    linked = ngram_join.linked(keyed.select(F.col("key").alias("doc_id"), "text"), n=5, percent=80).select(F.col("doc_id").alias("key"), "component_id")
    order = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"), F.col("key"))
    first = linked.join(keyed.select("key", order.alias("order")), "key").groupBy("component_id").agg(F.min("order").alias("order"))
    kept = first.select(F.col("order.key").alias("key"))
    return keyed.hint("merge").join(kept, "key", "left_semi").select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, weights=(1, 2, 3), most=3.0)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), window=2048, end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
