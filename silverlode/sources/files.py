"""File discovery, content fingerprints and the changed-files filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MANIFEST_KEYS = ["source_system", "file_name", "file_checksum"]

# Parts of a line's MD5 that are summed, and the hexadecimal digits of each.
_PARTS, _DIGITS = 4, 7
# The low bits of a monotonic id count the rows of a scan task.
_ROW_BITS = (1 << 33) - 1


def _listed(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select(
            "path",
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.col("length").alias("file_size_bytes"),
            F.col("_metadata.file_path").alias("_uri"),
        )
    )


def discover(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Non-empty files below ``folder`` as (path, file_name, file_size_bytes); contents are not read."""
    return _listed(spark, folder, pattern).drop("_uri")


def fingerprints(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """(path, file_name, file_size_bytes, file_checksum, uri) for every non-empty file below ``folder``.

    One digest for all sizes, from a scan that splits large files.  Lines are cut at
    line feeds only, so carriage returns count.  Each part of a line's MD5 is summed
    plainly and multiplied by the line's number; with the file's size (which shows a
    missing last line feed) the sums depend on every byte and on the order.  A block's
    sums know the line only within the block; the lines before it are added at the end,
    so nothing is sorted and the digest does not depend on where files are split.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("lineSep", "\n")
        .text(folder)
        .select(
            F.col("_metadata.file_path").alias("_uri"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().bitwiseAND(_ROW_BITS).cast("decimal(20,0)").alias("_row"),
            F.md5("value").alias("_md5"),
        )
    )
    parts = range(_PARTS)
    for k in parts:
        digits = F.substring("_md5", 1 + k * _DIGITS, _DIGITS)
        lines = lines.withColumn(f"_h{k}", F.conv(digits, 16, 10).cast("decimal(10,0)"))
    blocks = lines.groupBy("_uri", "_block").agg(
        F.count(F.lit(1)).alias("_lines"),
        F.min("_row").alias("_first"),
        *[F.sum(f"_h{k}").alias(f"_s{k}") for k in parts],
        *[F.sum(F.col(f"_h{k}") * F.col("_row")).alias(f"_t{k}") for k in parts],
    )
    # One row per block of a file.
    earlier = Window.partitionBy("_uri").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).cast("decimal(20,0)") - F.col("_first")
    summed = (
        blocks.withColumn("_shift", shift)
        .groupBy("_uri")
        .agg(
            F.sum("_lines").alias("_n"),
            *[F.sum(f"_s{k}").alias(f"_a{k}") for k in parts],
            *[F.sum(F.col(f"_t{k}") + F.col(f"_s{k}") * F.col("_shift")).alias(f"_b{k}") for k in parts],
        )
    )
    sums = ["_n", *[f"_{x}{k}" for k in parts for x in "ab"]]
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("0")) for c in sums]
    checksum = F.md5(F.concat_ws("|", F.col("file_size_bytes").cast("string"), *texts))
    return (
        _listed(spark, folder, pattern)
        .join(summed, "_uri", "left")
        .select("path", "file_name", "file_size_bytes", checksum.alias("file_checksum"), F.col("_uri").alias("uri"))
    )


def changed_files(candidates: DataFrame, manifest: DataFrame) -> DataFrame:
    """Candidates not yet processed with the same source, name and checksum."""
    done = manifest.filter(F.col("status") == "processed").select(*MANIFEST_KEYS)
    return candidates.join(done, MANIFEST_KEYS, "left_anti")
