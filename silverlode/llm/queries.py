"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm import divergence, lengths, mixing, neardup, neighbours, packing, passage_quality, passages, quality, quotes, spelling, token_files, toxicity
from silverlode.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    counted = quality.judge(docs)
    return counted.select("doc_id", "quality.*")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = passages.cut_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
    cut_words = F.expr("aggregate(passages, 0L, (n, p) -> n + p.end - p.begin)")
    return cut.select("doc_id", F.coalesce(cut_words, F.lit(0)).alias("n_cut_words"), "passages", "text")


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).drop("ids")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), digests=True)


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_plan(table(spark, sf_dir, "documents"))


def op8_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.conversations(table(spark, sf_dir, "conversations"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_passage_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_quality.passage_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.length_histogram(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_quality_rules": op2_quality_rules,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_nn_descent": op4_nn_descent,
    "op5_packing": op5_packing,
    "op6_token_files": op6_token_files,
    "op7_source_mixing": op7_source_mixing,
    "op8_quotation_linking": op8_quotation_linking,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_length_histogram": op10_length_histogram,
    "op11_source_divergence": op11_source_divergence,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_passage_quality": op13_passage_quality,
}
