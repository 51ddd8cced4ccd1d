"""Documents to tokens: quality rules, line dedup, near-duplicates, decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; ``run`` writes each result to the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from taskcurate.llm import bpe, catalog, decontaminate, quality, simhash, templates
from taskcurate.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.apply_quality_rules(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return templates.dedup_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """By the fingerprints of op9: components of prints at most three bits apart."""
    return simhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids)."""
    return bpe.encoded(docs, catalog.BYTE_BPE)


STAGES = [
    ("quality rules", quality_stage), ("line dedup", line_stage), ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage), ("BPE encoding", encoding_stage),
]

#: The last stage, BPE, cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
