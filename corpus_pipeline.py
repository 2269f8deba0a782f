"""A corpus from raw documents to packed sequences; every stage works on what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from silverlode.llm import mixing, neardup, packing, passages, quality
from silverlode.llm.common import prepare, quoted, store, table, unused


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    prepare(spark)
    return quality.reject_low_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    prepare(spark)
    return neardup.drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat an earlier document are cut from the text."""
    prepare(spark)
    (name,) = unused(docs, "_passages_cut")
    return passages.cut_passages(docs, name).select(*quoted(docs.columns))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out until each source has its target size."""
    prepare(spark)
    return mixing.mix(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full sequences."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mixing", source_mixing),
    ("sequence_packing", sequence_packing),
]

#: Near-duplicate classes, chains and token ids are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
