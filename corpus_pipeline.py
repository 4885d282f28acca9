"""From raw documents to a training mix: five stages, each on everything that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns documents with the same columns; the last one adds how often and with
how many words a document enters the mix. A stage's result is written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakekit.llm import decontaminate, mixing, near_dups, pii, quality
from lakekit.llm.common import stored
from lakekit.sources.erp import read_table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of the documents given."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (shingles of five words, similarity 0.8)."""
    return near_dups.drop_near_duplicates(docs)


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages; documents that consist of them for more than a half go."""
    return decontaminate.remove_contamination(docs, read_table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return pii.mask(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with copies, size and taken."""
    return mixing.take_mix(docs)


STAGES = [
    ("quality", keep_good),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", remove_benchmarks),
    ("pii", mask_personal_data),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# SQL can't express the trained classifiers and sketches: tests/llm/test_pipeline.py has plain versions of all stages.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
