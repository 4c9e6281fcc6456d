"""A training corpus from ``documents``: filter, deduplicate, mix and encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All stages but the last
return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeload.llm import bpe_automaton, mixing, rule_quality, simhash, suffix_dedup
from lakeload.llm.common import table
from lakeload.scratch import run_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from ``labels``, doesn't reject."""
    model = rule_quality.train(docs, table(spark, sf_dir, "labels"))
    scored = rule_quality.score_documents(docs, model, carry=True).where("predicted = 1")
    return scored.select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_one_of_each(docs, shingle=3, max_bits=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-byte strings that an earlier one holds."""
    kept = suffix_dedup.dedup_documents(docs, length=50)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix takes them."""
    return mixing.mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every copy."""
    found = bpe_automaton.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return found.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixture", mixture),
    ("encoding", encoding),
]

#: Fingerprints, trained scores and the tokenizer are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``; results between them lie in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = run_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            path = f"{folder}/{number}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
