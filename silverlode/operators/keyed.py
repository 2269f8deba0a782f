"""Key-based row operators: de-duplicate, anti-insert, upsert, update-from, latest-per-key.

Each reduces to a partial aggregate or an equi-join.  The aggregates combine on
the map side, so a key that holds a large share of all rows reaches its reducer
as at most one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions import quoted


def _winner(df: DataFrame, keys: Sequence[str], pick: str, fields: Sequence[str]) -> DataFrame:
    """The ``pick`` (min or max) of the struct of ``fields`` per key, unpacked again."""
    row = ", ".join(quoted(c) for c in fields)
    winner = df.groupBy(*keys).agg(F.expr(f"{pick}(struct({row}))").alias("_winner"))
    return winner.selectExpr(
        *[quoted(c) if c in keys else f"_winner.{quoted(c)} AS {quoted(c)}" for c in df.columns]
    )


def first_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by all other columns, in column order, NULL first."""
    rest = [c for c in df.columns if c not in keys]
    return _winner(df, keys, "min", rest) if rest else df.select(*keys).distinct()


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order_by``, NULL last; ties fall to the other columns.

    The lateral ``ORDER BY ... DESC LIMIT 1`` lookup as an aggregate: no sort per
    key, and the result is hash-partitioned on the key for the join that follows.
    """
    tail = [c for c in df.columns if c not in keys and c not in order_by]
    return _winner(df, keys, "max", [*order_by, *tail])


def absent_from(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``existing``.

    ``existing`` is first cut down to the incoming keys.  When the incoming batch
    is below the broadcast threshold, that cut is a broadcast semi-join, so a huge
    target is scanned for its key columns only and never shuffled.
    """
    present = existing.select(*keys).join(incoming.select(*keys), list(keys), "left_semi")
    return incoming.join(present, list(keys), "left_anti")


def merge_rows(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert: rows of ``incoming`` replace rows of ``existing`` with the same key."""
    kept = existing.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.unionByName(incoming)


def update_columns(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """``UPDATE target SET columns FROM updates``: unmatched rows keep their values.

    ``updates`` holds each key at most once.  A matched NULL overwrites, as SQL does.
    """
    marked = updates.select(
        *keys, F.struct(*columns).alias("_new"), F.lit(True).alias("_hit")
    )
    joined = target.join(marked, list(keys), "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new.{c}")).otherwise(target[c]).alias(c)
            if c in columns
            else F.col(c)
            for c in target.columns
        ]
    )


def has_null_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], F.lit(False))


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a complete key, and the rejected rows where some key column is NULL."""
    return df.filter(~has_null_key(keys)), df.filter(has_null_key(keys))
