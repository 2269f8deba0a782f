"""Small report operators over already aggregated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlode.functions import ratio


def share_of_total(df: DataFrame, count_column: str, scale: int, target: str) -> Column:
    """``count / sum(count) over ()`` as an expression for ``df``.

    The total is a scalar subquery over partial sums, so the groups are never
    gathered into one task as an unpartitioned window would do.
    """
    total = df.agg(F.sum(count_column).alias("total")).scalar()
    return ratio(F.col(count_column), total, scale, target)


def top_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows in ``order``; planned as one top-k pass, not a full sort."""
    return df.orderBy(*order).limit(k)


def running_delta(counts: DataFrame, name: str, added: str, start: int = 0) -> DataFrame:
    """Rows before / added / after per load step.

    ``counts`` holds one row per loaded file, so the ordered window over it is
    bounded by the number of files, not by the data.
    """
    upto = Window.orderBy(name).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = F.lit(start) + F.sum(added).over(upto)
    return counts.select(
        name,
        (after - F.col(added)).cast("bigint").alias("rows_before"),
        F.col(added).cast("bigint").alias("rows_added"),
        after.cast("bigint").alias("rows_after"),
    )
