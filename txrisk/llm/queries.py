"""One query for each operator, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from txrisk.llm import bwt_dedup, ctw, decontaminate, divergence, mixing, periodic_runs, pii_bootstrap, quality_fm, quality_rules, signature_tree, toxicity_gru, warc_chunks, winnow
from txrisk.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_chunks.roundtrip_report(table(spark, sf_dir, "pages"))


def op3_signature_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_tree.join_report(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op5_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.dedup_report(table(spark, sf_dir, "documents"))


def op6_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.lm_report(table(spark, sf_dir, "documents"))


def op7_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_bootstrap.pii_report(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.fingerprint_report(table(spark, sf_dir, "documents"))


def op10_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_gru.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence_report(table(spark, sf_dir, "documents"))


def op12_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


def op13_recompression_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_fm,
        op2_warc_chunks,
        op3_signature_tree,
        op4_mixing,
        op5_bwt_dedup,
        op6_ctw,
        op7_pii_bootstrap,
        op8_decontaminate,
        op9_winnow,
        op10_toxicity_gru,
        op11_source_divergence,
        op12_quality_mcd,
        op13_recompression_runs,
    )
} | {"pipeline": corpus_pipeline.run}
ORACLE: dict[str, str] = {"op4_mixing": mixing.ORACLE_SQL, "op8_decontaminate": decontaminate.ORACLE_SQL, "op11_source_divergence": divergence.ORACLE_SQL}
