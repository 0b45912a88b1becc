"""Queries of the training-data operators, each over its whole table with production parameters, and their DuckDB SQL
where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from reelsift.llm import chat_format, decontamination, isolation_rules, label_propagation, minhash, minmax_dedup, mix_tree, packing, quality_classifier, spelling, sql, tag_paths, token_alignment, toxicity

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_paths.extracted(table(spark, sf_dir, "pages"))


def op2_isolation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return isolation_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_propagation.shard_documents(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.chat_digests(spark, table(spark, sf_dir, "conversations"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprints_with_edit(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_mix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_tree.mixture(table(spark, sf_dir, "documents"))


def op11_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_gram_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op13_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_tag_paths": op1_tag_paths,
    "op2_isolation_rules": op2_isolation_rules,
    "op3_label_propagation": op3_label_propagation,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_chat_format": op5_chat_format,
    "op6_minhash": op6_minhash,
    "op7_packing": op7_packing,
    "op8_toxicity": op8_toxicity,
    "op9_minmax_dedup": op9_minmax_dedup,
    "op10_mix_tree": op10_mix_tree,
    "op11_suffix_arrays": op11_suffix_arrays,
    "op12_gram_blocks": op12_gram_blocks,
    "op13_fragments": op13_fragments,
    "pipeline": corpus_pipeline.run,
}
ORACLE: dict[str, str] = {
    "op1_tag_paths": sql.OP1_SQL,
    "op5_chat_format": sql.OP5_SQL,
    "op9_minmax_dedup": sql.OP9_SQL,
    "op11_suffix_arrays": sql.OP11_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
