"""Dense row numbers without a single-task window.

``row_number() over (partition by g order by k)`` puts every group into one task,
and a surrogate key sequence (no groups) puts the whole table into one.  Here the
rows are range-partitioned on ``(group, order)``, so a large group spans many
tasks; each task numbers its own slice and a small table of slice sizes supplies
the starting offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverlode.session import scratch_path

# monotonically_increasing_id keeps the partition number above bit 33.
_PARTITION_SHIFT = 33


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a copy that outlives executors, and lets later branches
    read the same rows with column pruning instead of recomputing them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    column: str,
    group_by: Sequence[str] = (),
    after: int = 0,
) -> DataFrame:
    """Add ``column`` = ``after`` + 1, 2, 3, ... in ``order_by`` order, per group if given.

    ``(group_by, order_by)`` should be unique; group values must not be NULL.  The
    slices are written once before they are counted: a second evaluation could cut
    the ranges elsewhere and make the offsets wrong.
    """
    cuts = [*group_by, *order_by]
    sliced = (
        df.repartitionByRange(*cuts)
        .sortWithinPartitions(*cuts)
        .withColumn("_seq", F.monotonically_increasing_id())
    )
    rows = pin(sliced, "numbered").withColumn("_slice", F.shiftright("_seq", _PARTITION_SHIFT))

    # At most one entry per slice plus one per group, so this window stays small.  The
    # offsets are stored as well: their size is then known before the join is planned,
    # and the rows are not shuffled when it is below the broadcast threshold.
    before = (
        Window.partitionBy(*group_by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        rows.groupBy(*group_by, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_seq").alias("_first"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    numbered = rows.join(pin(offsets, "offsets"), [*group_by, "_slice"])
    number = F.lit(after) + F.col("_offset") + F.col("_seq") - F.col("_first") + F.lit(1)
    return numbered.select(*df.columns, number.cast("bigint").alias(column))
