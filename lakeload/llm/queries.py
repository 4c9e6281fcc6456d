"""The registered queries of this subpackage."""

from __future__ import annotations

import importlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeload.llm import bpe_automaton, divergence, hamming_search, html_density, language_kernel, license_scan, line_quality, mixing, periodic_runs, rule_quality, sharding, simhash, suffix_dedup
from lakeload.llm.common import table
from lakeload.scratch import run_dir

EMBEDDING_DIMS = 64
TOP_K = 10


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=50, with_text=False)
    return found.select(F.col("_row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return hamming_search.top_k(rows, rows.where("vec_id % 20 = 0"), EMBEDDING_DIMS, TOP_K)


def op3_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_quality(table(spark, sf_dir, "documents"), with_text=False).drop("lost_share")


def op5_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op6_language_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_kernel.identify(docs, language_kernel.train(docs, folds=3, held_out=1))
    return found.select("doc_id", rule_quality.in_fold("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


def op7_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = rule_quality.train(docs, table(spark, sf_dir, "labels"), folds=5, held_out=0)
    found = rule_quality.score_documents(docs, model, threshold=0.3)
    return found.select("doc_id", rule_quality.in_fold("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op9_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2).withColumnRenamed("id", "doc_id")


def op10_html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_density.main_texts(table(spark, sf_dir, "pages"))


def op11_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), run_dir(spark, "slot-map"), shards=8)


def op12_segment_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), least_docs=30, best=50)


def op13_repair_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), plant=True, with_text=False)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importlib.import_module("corpus_pipeline").run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_hamming_top_k,
        op3_entropy_mixing,
        op4_line_quality,
        op5_bpe_automaton,
        op6_language_kernel,
        op7_rule_quality,
        op8_license_scan,
        op9_simhash_ball,
        op10_html_density,
        op11_virtual_slots,
        op12_segment_trees,
        op13_repair_runs,
        pipeline,
    )
}
