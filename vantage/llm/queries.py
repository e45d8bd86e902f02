"""The registered queries of this subpackage: name -> f(spark, sf_dir), and DuckDB texts where SQL expresses them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vantage.llm import (bpe, decontamination, fim, langid, licenses, mtree, shard_tree, simhash, token_alignment, token_files, toxicity,
                         tree_bpe, warc_zip)
from vantage.llm.common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_tree.shard_documents(table(spark, sf_dir, "documents"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.grouped(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), found["component"].alias("component_id"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(table(spark, sf_dir, "documents"))


def op4_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.search_table(table(spark, sf_dir, "embeddings"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.count_documents(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


def op8_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.round_trip(table(spark, sf_dir, "pages"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.report(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.report(table(spark, sf_dir, "documents"))


def op13_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_bpe.token_digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_sharding, op2_simhash_near_dedup, op3_language_id, op4_top_k_search, op5_token_counts, op6_toxicity,
        op7_license_scan, op8_warc_zip, op9_decontamination, op10_bpe, op11_token_alignment, op12_fill_in_middle, op13_tree_bpe)}


def oracle_sql() -> dict[str, str]:
    return {"op4_top_k_search": mtree.ORACLE_SQL, "op8_warc_zip": warc_zip.ORACLE_SQL,
            "op9_decontamination": decontamination.ORACLE_SQL, "op12_fill_in_middle": fim.ORACLE_SQL}
