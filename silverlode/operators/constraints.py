"""Row constraints checked while rows are written: NOT NULL and CHECK.

All constraints of a table are evaluated in one pass into a bit set per row.  Rows with a
zero set are kept, the others are set aside with the names of what they failed; a strict
load stops at the first failing row instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions import quoted
from silverlode.operators.numbering import pin

FAILED = "_failed"


@dataclass(frozen=True)
class Constraint:
    """``violated`` is SQL that is TRUE for a failing row; as in SQL, a CHECK over a NULL passes."""

    name: str
    violated: str


def not_null(*columns: str) -> list[Constraint]:
    return [Constraint(f"{c}_not_null", f"{quoted(c)} IS NULL") for c in columns]


def check(name: str, condition: str) -> Constraint:
    return Constraint(name, f"NOT ({condition})")


def failure_bits(constraints: Sequence[Constraint]) -> Column:
    """Bit ``i`` is set when constraint ``i`` fails; at most 63 constraints."""
    if len(constraints) > 63:
        raise ValueError("at most 63 constraints per table")
    bits = [f"if(coalesce({c.violated}, FALSE), {1 << i}L, 0L)" for i, c in enumerate(constraints)]
    return F.expr(" | ".join(bits) if bits else "0L")


def failed_names(bits: str, constraints: Sequence[Constraint]) -> Column:
    names = [F.when(F.expr(f"{bits} & {1 << i}L <> 0"), F.lit(c.name)) for i, c in enumerate(constraints)]
    return F.array_compact(F.array(*names))


def split_rows(df: DataFrame, constraints: Sequence[Constraint]) -> tuple[DataFrame, DataFrame]:
    """(kept rows, failing rows with ``_failed``: the names of what they fail), from one stored pass over ``df``."""
    marked = pin(df.withColumn(FAILED, failure_bits(constraints)), "constraints")
    kept = marked.where(f"{FAILED} = 0").drop(FAILED)
    return kept, marked.where(f"{FAILED} <> 0").withColumn(FAILED, failed_names(FAILED, constraints))


def enforce(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """``df`` that raises on the first failing row, in the pass that reads it; no row is dropped."""
    text = F.concat_ws(", ", failed_names(FAILED, constraints))
    stop = F.raise_error(F.concat(F.lit("violated constraints: "), text))
    checked = df.withColumn(FAILED, failure_bits(constraints))
    return checked.where(F.when(F.col(FAILED) == 0, F.lit(True)).otherwise(stop)).drop(FAILED)


def failure_counts(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """(constraint_name, rows_failed, rows_checked) in one aggregate, whatever the number of constraints."""
    bits = df.select(failure_bits(constraints).alias(FAILED))
    counted = bits.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.expr(f"{FAILED} & {1 << i}L <> 0")).alias(f"c{i}") for i in range(len(constraints))]
    )
    entries = [F.struct(F.lit(c.name).alias("constraint_name"), F.col(f"c{i}").alias("rows_failed")) for i, c in enumerate(constraints)]
    return counted.select(F.col("n").alias("rows_checked"), F.inline(F.array(*entries))).select(
        "constraint_name", "rows_failed", "rows_checked"
    )
