"""Source rows to bronze rows: expected columns, lineage columns, one row per business key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions import row_hash
from silverlode.operators.keyed import first_per_key
from silverlode.schemas import TABLES, TableSpec


def stamp(batch_id: str | None = None, loaded_at: datetime | None = None) -> dict[str, Column]:
    """Load time and batch id are job parameters, so a plan gives the same rows when a task is rerun."""
    return {
        "_loaded_at": F.lit(loaded_at).cast("timestamp"),
        "_batch_id": F.lit(batch_id).cast("string"),
    }


def with_lineage(
    df: DataFrame,
    table: str,
    source_system: str,
    batch_id: str | None = None,
    loaded_at: datetime | None = None,
) -> DataFrame:
    """The delivered business columns of ``table`` plus lineage; the hash covers the business columns."""
    spec: TableSpec = TABLES[table]
    delivered = [c for c in spec.business_columns if c in df.columns]
    df = df.select(*delivered, *[c for c in ("_file_name", "_file_uri") if c in df.columns])
    return df.withColumns(
        {
            "_source_system": F.lit(source_system),
            **stamp(batch_id, loaded_at),
            "_row_hash": row_hash(f for f in df.schema if f.name in delivered),
        }
    )


def land(df: DataFrame, table: str, source_system: str) -> DataFrame:
    """Bronze rows of a first load: the smallest row of each key, with lineage.

    Key winners are picked before hashing, so duplicates are not hashed.
    """
    return with_lineage(first_per_key(df, TABLES[table].keys), table, source_system)
