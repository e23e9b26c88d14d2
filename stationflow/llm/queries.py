"""Registered queries of the text operators: each applies one operator, with its defaults, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    ann,
    divergence,
    importance,
    lines,
    mixing,
    odd_sketch,
    oracle,
    overlap_join,
    packing,
    phrases,
    pii,
    toxicity,
    url_tree,
    wavelet,
)
from .tables import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.query(read(spark, sf_dir, "embeddings"))


def op2_bin_completion_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.query(read(spark, sf_dir, "documents"))


def op3_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.query(read(spark, sf_dir, "documents"))


def op4_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.query(read(spark, sf_dir, "documents"))


def op5_dictionary_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.query(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_odd_sketch_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.query(read(spark, sf_dir, "documents"))


def op7_line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.query(read(spark, sf_dir, "documents"))


def op8_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_tree.query(read(spark, sf_dir, "pages"))


def op9_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.query(read(spark, sf_dir, "documents"))


def op10_deobfuscated_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.query(read(spark, sf_dir, "documents"))


def op11_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_join.query(read(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.query(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.query(read(spark, sf_dir, "documents"))


def llm_queries() -> dict[str, Query]:
    found = [
        op1_rotated_codes,
        op2_bin_completion_packing,
        op3_wavelet_tokens,
        op4_pareto_mix,
        op5_dictionary_toxicity,
        op6_odd_sketch_duplicates,
        op7_line_cleaning,
        op8_path_templates,
        op9_repeated_phrases,
        op10_deobfuscated_pii,
        op11_overlap_join,
        op12_importance_resampling,
        op13_source_divergence,
    ]
    return {f.__name__: f for f in found}


def llm_sql() -> dict[str, str]:
    """SQL for the queries that it can state; tests hold the others against brute force."""
    return {
        op6_odd_sketch_duplicates.__name__: oracle.DUPLICATES,
        op9_repeated_phrases.__name__: oracle.PHRASES,
        op11_overlap_join.__name__: oracle.OVERLAPS,
        op12_importance_resampling.__name__: oracle.RESAMPLING,
        op13_source_divergence.__name__: oracle.DIVERGENCE,
    }
