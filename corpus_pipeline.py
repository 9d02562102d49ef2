"""Corpus pipeline: language ID, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the next one's docs.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import common, decontaminate, language_id, line_dedup, mixing, simhash_dedup


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told (no letters, no text, or no class above chance) go."""
    return language_id.keep_known(docs)


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that 10 documents or more share go from the texts; n_chars follows.  All documents stay."""
    return common.sized(line_dedup.drop_lines(docs, min_docs=10), docs.count())


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, that of the least id."""
    return common.sized(simhash_dedup.keep_one(docs, words=5, similarity=0.8), docs.count())


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a 10-word window of a benchmark item go."""
    return common.sized(decontaminate.clean_documents(docs, common.table(spark, sf_dir, "benchmark"), size=10), docs.count())


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, epochs and rest of each document that the mix takes words of."""
    return mixing.mix(docs).where(F.col("taken") > 0)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", shared_lines),
    ("near_dedup", near_duplicates),
    ("decontaminate", benchmark_passages),
    ("mix_sources", source_mix),
]

#: The kernel classifier and the SimHash classes can't be put in SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; between stages the rows go through the shared folder."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
