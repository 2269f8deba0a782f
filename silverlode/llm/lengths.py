"""Exact length histogram: one row per encoded length answers every context limit."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverlode.llm.common import store
from silverlode.llm.tokens import encoder, tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
# Lengths per slice of the two-level suffix sums.
SLICE = 1024


def token_count(path: str):
    """A column function: token ids per text (null: 0)."""

    @F.arrow_udf("long")
    def count(text: pa.Array) -> pa.Array:
        return pa.array([len(ids) // 4 for ids in encoder(path).encode(text.to_pylist())], pa.int64())

    return count


def length_histogram(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Per distinct encoded length of ``text``: documents and tokens of that length and of at least it.

    ``truncated_total`` is the corpus size when every document is cut at ``length``
    tokens; ``share`` is the part of documents of at most this length, so the
    smallest ``length`` with ``share >= q`` is the exact q-quantile.  Null and empty
    texts count with length 0; repeated rows count as often as they occur; an empty
    table gives no rows.  Other columns are ignored.
    """
    count = token_count(tokenizer or tokenizer_path(TOKENIZER))
    lengths = docs.select(count(F.col("text")).alias("length"))
    histogram = store(
        lengths.groupBy("length").agg(F.count(F.lit(1)).alias("n_docs")).withColumn("n_tokens", F.expr("length * n_docs")),
        "lengths",
    )
    # Suffix sums within slices of SLICE lengths, plus the sums of all later slices: neither
    # window holds more than SLICE rows or one row per slice.
    sliced = histogram.withColumn("slice", F.expr(f"length div {SLICE}"))
    later = Window.orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy()
    slices = sliced.groupBy("slice").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
    slices = slices.select(
        "slice",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("d").over(total).alias("total_docs"),
        F.sum("t").over(total).alias("total_tokens"),
    )
    here = Window.partitionBy("slice").orderBy(F.desc("length"))
    summed = sliced.join(slices, "slice").select(
        "length",
        "n_docs",
        "n_tokens",
        (F.col("later_docs") + F.sum("n_docs").over(here)).alias("docs_at_least"),
        (F.col("later_tokens") + F.sum("n_tokens").over(here)).alias("tokens_at_least"),
        "total_docs",
        "total_tokens",
    )
    return summed.select(
        "*",
        F.expr("total_tokens - tokens_at_least + length * docs_at_least").alias("truncated_total"),
        F.expr("(total_docs - docs_at_least + n_docs) / cast(total_docs as double)").alias("share"),
    )


def truncated_total(histogram: DataFrame, limit: int) -> int:
    """Tokens left when every document is cut at ``limit``, for any limit."""
    row = histogram.agg(F.sum(F.least("length", F.lit(limit)) * F.col("n_docs"))).first()
    return row[0] or 0


def quantile(histogram: DataFrame, q: float) -> int | None:
    """The smallest length that a share ``q`` of the documents does not exceed."""
    return histogram.where(F.col("share") >= q).agg(F.min("length")).first()[0]
