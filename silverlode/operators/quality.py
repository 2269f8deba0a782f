"""Declarative data-quality rules compiled to one aggregate per table.

A rule list becomes a single scan of each table (one ``count_if`` per rule) plus
one join for all referential rules against the same parent.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions import ratio

NULL_CHECK = "null_check"
RANGE = "range"
VOLUME = "volume"
UNIQUE = "unique"
REFERENTIAL = "referential"


@dataclass(frozen=True)
class Rule:
    """One check of one table.

    ``failing`` is a SQL predicate for bad rows.  A volume rule has none: it fails on
    an empty table.  A unique rule names its ``key`` and counts rows beyond the first.
    """

    table: str
    name: str
    kind: str
    critical: bool
    failing: str | None = None
    key: tuple[str, ...] = ()


@dataclass(frozen=True)
class Reference:
    """Child rows whose ``key`` has no match in ``parent``; a NULL key counts as an orphan."""

    table: str
    parent: str
    key: str
    name: str = "orphan_order_id"
    kind: str = REFERENTIAL
    critical: bool = False


RESULT_COLUMNS = (
    "table_name", "check_name", "check_type", "status", "rows_checked", "rows_failed",
    "failure_percentage", "critical",
)


def _with_status(counts: DataFrame) -> DataFrame:
    """Add status and failure percentage to (table, check, type, critical, checked, failed)."""
    failed = F.col("rows_failed") > 0
    status = (
        F.when(failed & F.col("critical"), "failed")
        .when(failed, "warning")
        .otherwise("passed")
    )
    percentage = ratio(F.col("rows_failed") * 100, F.col("rows_checked"), 4, "decimal(8,4)")
    return counts.withColumns({"status": status, "failure_percentage": percentage}).select(
        *RESULT_COLUMNS
    )


def _entry(rule: Rule | Reference, checked: Column, failed: Column) -> Column:
    return F.struct(
        F.lit(rule.table).alias("table_name"),
        F.lit(rule.name).alias("check_name"),
        F.lit(rule.kind).alias("check_type"),
        F.lit(rule.critical).alias("critical"),
        checked.cast("bigint").alias("rows_checked"),
        failed.cast("bigint").alias("rows_failed"),
    )


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def check_rules(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """Run row, volume and unique rules: one pass per table, whatever the number of rules.

    A table with a unique rule is counted per key first (combined on the map side),
    and its other rules ride on the same aggregate.
    """
    frames = []
    for table, key in dict.fromkeys((r.table, _key_of(rules, r.table)) for r in rules):
        own = [r for r in rules if r.table == table]
        measures = [F.count(F.lit(1)).alias("_rows")] + [
            F.count_if(F.expr(r.failing)).alias(f"_bad{i}") for i, r in enumerate(own) if r.failing
        ]
        if key:
            per_key = tables[table].groupBy(*key).agg(*measures)
            names = [c for c in per_key.columns if c not in key]
            totals = per_key.agg(
                *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names], F.count(F.lit(1)).alias("_keys")
            )
        else:
            totals = tables[table].agg(*measures)
        entries = [_entry(r, F.col("_rows"), _failed_rows(r, i)) for i, r in enumerate(own)]
        frames.append(totals.select(F.inline(F.array(*entries))))
    return _with_status(_union(frames))


def _key_of(rules: Sequence[Rule], table: str) -> tuple[str, ...]:
    keys = {r.key for r in rules if r.table == table and r.kind == UNIQUE}
    if len(keys) > 1:
        raise ValueError(f"{table}: unique rules over different keys need separate runs")
    return keys.pop() if keys else ()


def _failed_rows(rule: Rule, position: int) -> Column:
    if rule.kind == UNIQUE:
        return F.col("_rows") - F.col("_keys")
    if rule.kind == VOLUME:
        return F.when(F.col("_rows") == 0, 1).otherwise(0)
    return F.col(f"_bad{position}")


def check_references(tables: Mapping[str, DataFrame], references: Sequence[Reference]) -> DataFrame:
    """Run referential rules; children of one parent share a single join.

    Child rows are first counted per key, so a hot key shuffles as one row per map
    task, and the parent is read once for all of its children.
    """
    frames = []
    for parent, key in dict.fromkeys((r.parent, r.key) for r in references):
        own = [r for r in references if (r.parent, r.key) == (parent, key)]
        tagged = [
            tables[r.table].select(
                key, *[F.lit(1 if j == i else 0).cast("bigint").alias(f"_n{j}") for j in range(len(own))]
            )
            for i, r in enumerate(own)
        ]
        per_key = _union(tagged).groupBy(key).agg(
            *[F.sum(f"_n{i}").alias(f"_n{i}") for i in range(len(own))]
        )
        known = tables[parent].select(key).distinct().withColumn("_known", F.lit(True))
        totals = per_key.join(known, key, "left").agg(
            *[F.coalesce(F.sum(f"_n{i}"), F.lit(0)).alias(f"_rows{i}") for i in range(len(own))],
            *[
                F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col(f"_n{i}"))), F.lit(0)).alias(
                    f"_bad{i}"
                )
                for i in range(len(own))
            ],
        )
        entries = [_entry(r, F.col(f"_rows{i}"), F.col(f"_bad{i}")) for i, r in enumerate(own)]
        frames.append(totals.select(F.inline(F.array(*entries))))
    return _with_status(_union(frames))


def run_checks(
    tables: Mapping[str, DataFrame], rules: Sequence[Rule], references: Sequence[Reference]
) -> DataFrame:
    """All rules of a layer as one result frame, one row per check."""
    return check_rules(tables, rules).unionByName(check_references(tables, references))


def summarize(results: DataFrame) -> DataFrame:
    """Number of checks and of failed critical checks."""
    return results.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_checks"),
        F.count_if(F.col("status") == "failed").cast("bigint").alias("failed_critical"),
        F.count_if(F.col("status") == "warning").cast("bigint").alias("warnings"),
    )


def raise_on_critical(results: DataFrame) -> None:
    """Stop the run when a critical check failed; ``results`` has one row per check."""
    failed = (
        results.filter(F.col("status") == "failed")
        .select("table_name", "check_name", "rows_failed")
        .orderBy("table_name", "check_name")
        .collect()
    )
    if failed:
        names = ", ".join(f"{r.table_name}.{r.check_name}={r.rows_failed}" for r in failed)
        raise ValueError(f"critical data-quality checks failed: {names}")
