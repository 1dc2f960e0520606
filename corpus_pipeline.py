"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, source mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and is written as Parquet;
the next one reads it back. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stillhouse.llm import linededup, mixing, packing, quality, simhash
from stillhouse.llm.common import documents, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above their host's limit go from the others."""
    return quality.clean(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each group of alike lines stays."""
    return linededup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated until sources meet their target weights."""
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

# Tokenisation, SimHash and fuzzy lines are beyond SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
