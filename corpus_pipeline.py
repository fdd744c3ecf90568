"""A corpus-cleaning pipeline over ``documents``: each stage reads what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumrank.llm import ngram_join, packing, pii, toxicity
from quorumrank.llm.shared import forget, stored


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by word shingles, the one with the smallest id stays; of repeated rows one."""
    return ngram_join.keep_one(docs)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values become pseudonyms, by the key in the session's configuration, and n_chars counts the new text."""
    out = pii.pseudonymise(docs)
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast("long"))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("pii", pseudonyms),
    ("packing", packed),
]

#: SQL can't express the learned and packed stages; tests hold the pipeline against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and reread."""
    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), False
    for name, stage in STAGES[:-1]:
        kept = stored(stage(spark, docs, sf_dir), name)
        if written:
            forget(spark, docs)
        docs, written = kept, True
    return STAGES[-1][1](spark, docs, sf_dir)
