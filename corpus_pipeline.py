"""From raw documents to packed training sequences: four stages over `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import table, written
from tidegauge.llm.lines import dedup_lines
from tidegauge.llm.packing import pack_documents
from tidegauge.llm.quality import keep_good
from tidegauge.llm.simhash import keep_first


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every line class keeps its first line; ``n_chars`` follows the text."""
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the first."""
    return keep_first(docs, words=3, distance=2)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 2048 words."""
    return pack_documents(docs, capacity=2048)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Rules, near-duplicate groups and packing are not expressible in SQL; tests compare
#: the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn; each reads what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
