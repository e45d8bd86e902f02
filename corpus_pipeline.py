"""Corpus pipeline: language, toxicity, near-dedup, benchmark decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's documents, so a lost executor costs one stage at most. All stages but the last return the columns of documents,
whatever further columns these have. Repeated rows are judged alike, very long texts whole, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vantage.llm import bpe, decontamination, langid, simhash, toxicity
from vantage.llm.common import settle, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay whose language the network can tell, likelier than a guess would; null and letterless texts go. With no
    labelled document in the corpus nothing can be told, and every text with a letter stays."""
    return langid.accepted(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; null and empty texts stay. Without labels of both kinds all stay."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (4-word shingles, at most 4 differing bits) the smallest doc_id stays. Null, empty and
    wordless texts are copies of each other."""
    return simhash.deduplicate(docs, words=4, distance=4)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark items go; null and wordless texts stay."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what is left; a null text counts as empty."""
    return bpe.token_digests(docs)


STAGES = [("language", language_stage), ("toxicity", toxicity_stage), ("near_dedup", near_dedup_stage),
          ("decontamination", decontamination_stage), ("bpe", bpe_stage)]

#: Learned models and XXH64 are beyond SQL; tests compare run() with a plain Python computation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
