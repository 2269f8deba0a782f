"""Parquet tables below one root folder, with the write policies of the pipelines.

Every policy can be run again after a crash: the inserting and upserting ones are
idempotent by key, and a path is never overwritten while it is being read.  A
load first writes its batch to the shared folder, so the batch is computed once,
its size is known to the planner (a small batch is broadcast against a large
target) and lost executors cannot change it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.operators.keyed import (
    absent_from,
    first_per_key,
    has_null_key,
    latest_per_key,
    merge_rows,
    split_null_keys,
)
from silverlode.operators.numbering import pin
from silverlode.schemas import TABLES, TableSpec
from silverlode.session import path_exists
from silverlode.sinks.growing import GrowingTable

BUCKET = "bucket"


@dataclass(frozen=True)
class LoadReport:
    """Outcome of one load: rows offered, set aside for a NULL key, before, added, after."""

    table: str
    rows_attempted: int
    rows_rejected: int
    rows_before: int
    rows_inserted: int
    rows_after: int
    status: str = "success"

    def as_dict(self) -> dict:
        return asdict(self)


class TableStore:
    def __init__(self, spark: SparkSession, root: str, tables: dict[str, TableSpec] = TABLES):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = tables

    # --- layout ---------------------------------------------------------------
    def path(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def exists(self, table: str) -> bool:
        return path_exists(self.spark, self.path(table))

    def growing(self, table: str) -> GrowingTable | None:
        """The table as hash buckets that split, if its layout says so."""
        spec = self.tables[table]
        if not spec.bucket_rows:
            return None
        return GrowingTable(self.spark, self.path(table), spec.schema, spec.keys, spec.bucket_rows)

    def stored_schema(self, table: str) -> T.StructType:
        spec = self.tables[table]
        extra = [T.StructField(name, dtype) for name, dtype in self._layout_columns(spec)]
        return T.StructType([*spec.schema.fields, *extra])

    @staticmethod
    def _layout_columns(spec: TableSpec) -> list[tuple[str, T.DataType]]:
        columns: list[tuple[str, T.DataType]] = []
        if spec.partition_by:
            columns.append((spec.partition_by[0], T.DateType()))
        if spec.buckets:
            columns.append((BUCKET, T.IntegerType()))
        return columns

    def bootstrap(self, tables: Sequence[str] | None = None) -> None:
        """Create the missing tables, empty and typed."""
        for table in tables or self.tables:
            if not self.exists(table):
                self._write(self._empty(table), table, "ignore")

    def _empty(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], self.tables[table].schema)

    def read(self, table: str) -> DataFrame:
        """The stored rows; an absent table reads as empty.  Layout columns are kept for pruning."""
        if not self.exists(table):
            return self._laid_out(self._empty(table), table)
        if grown := self.growing(table):
            return grown.read()
        return self.spark.read.schema(self.stored_schema(table)).parquet(self.path(table))

    def rows(self, table: str) -> DataFrame:
        """The stored rows without layout columns."""
        return self.read(table).select(*self.tables[table].schema.names)

    def count(self, table: str) -> int:
        """Stored rows; a growing table has the number in its directory."""
        grown = self.growing(table)
        return grown.rows_stored() if grown else self.read(table).count()

    # --- shaping ----------------------------------------------------------------
    def conform(self, df: DataFrame, table: str, extra: Sequence[str] = ()) -> DataFrame:
        """The table's columns in order and type; absent columns are NULL or their default."""
        spec = self.tables[table]

        def shaped(field: T.StructField) -> Column:
            col = F.col(field.name) if field.name in df.columns else F.lit(None)
            if field.name in spec.defaults:
                col = F.coalesce(col, F.lit(spec.defaults[field.name]))
            return col.cast(field.dataType).alias(field.name)

        return df.select(*[shaped(f) for f in spec.schema], *extra)

    def _laid_out(self, df: DataFrame, table: str) -> DataFrame:
        spec = self.tables[table]
        if spec.partition_by:
            name, source = spec.partition_by
            df = df.withColumn(name, F.trunc(source, "month"))
        if spec.buckets:
            bucket = F.pmod(F.xxhash64(*spec.keys), F.lit(spec.buckets)).cast("int")
            df = df.withColumn(BUCKET, bucket)
        return df

    def _write(self, df: DataFrame, table: str, mode: str, whole: bool = False) -> None:
        """Write with the table's layout.

        The rebalance hint lets AQE merge small and split large output partitions per
        folder, so a hot month does not become one giant task or one giant file.
        """
        spec = self.tables[table]
        if grown := self.growing(table):
            if mode == "overwrite":
                grown.replace(df)
            elif mode == "append" or not self.exists(table):
                grown.insert(df)
            return
        folders = [name for name, _ in self._layout_columns(spec)]
        laid_out = self._laid_out(df, table)
        if folders:
            laid_out = laid_out.hint("rebalance", *folders)
        # Only bucket folders are replaced one by one: a row's bucket never changes.
        overwrite = "dynamic" if spec.buckets and not whole else "static"
        writer = laid_out.write.mode(mode).option("partitionOverwriteMode", overwrite)
        (writer.partitionBy(*folders) if folders else writer).parquet(self.path(table))

    # --- policies -----------------------------------------------------------------
    def append(self, table: str, df: DataFrame) -> LoadReport:
        """Plain bulk append, no keys checked."""
        before = self.count(table)
        self._write(self.conform(df, table), table, "append")
        after = self.count(table)
        return LoadReport(table, after - before, 0, before, after - before, after)

    def stage(self, table: str, df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
        """The batch in table shape, written once; everything after reads this copy.

        ``extra`` columns stand behind those of the table and are not stored in it.
        """
        return pin(self.conform(df, table, extra), "batch")

    def fresh_rows(self, table: str, staged: DataFrame) -> DataFrame:
        """One row per complete key of the batch that the table does not hold yet."""
        spec = self.tables[table]
        keyed, _ = split_null_keys(staged, spec.required)
        winners = first_per_key(keyed, spec.keys)
        if self.exists(table) and (grown := self.growing(table)):
            return grown.absent(winners)
        return absent_from(winners, self.read(table), spec.keys) if self.exists(table) else winners

    def insert_fresh(self, table: str, staged: DataFrame, fresh: DataFrame) -> LoadReport:
        """Append ``fresh``; rows of the batch with a NULL in a required column go to ``<table>_rejects``."""
        spec = self.tables[table]
        offered = staged.agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(has_null_key(spec.required)).alias("rejected")
        ).first()
        if offered.rejected:
            self._set_aside(table, staged)
        before = self.count(table)
        self._write(fresh.select(*spec.schema.names), table, "append")
        after = self.count(table)
        return LoadReport(table, offered.rows, offered.rejected, before, after - before, after)

    def _set_aside(self, table: str, staged: DataFrame) -> None:
        """Append the rows with a NULL in a required column to ``<table>_rejects``."""
        spec = self.tables[table]
        _, unkeyed = split_null_keys(staged, spec.required)
        unkeyed.select(*spec.schema.names).write.mode("append").parquet(self.path(table) + "_rejects")

    def insert_if_absent(self, table: str, df: DataFrame) -> LoadReport:
        """Insert the rows whose key is not stored yet; the first row of a key wins for good.

        Rows with a NULL key are set aside instead of failing the load.
        """
        staged = self.stage(table, df)
        return self.insert_fresh(table, staged, self.fresh_rows(table, staged))

    def upsert(self, table: str, df: DataFrame, order_by: Sequence[str] = ()) -> LoadReport:
        """Insert or replace by key; inside a batch the greatest ``order_by`` wins.

        For a bucketed table only the bucket folders that the batch touches are merged
        and replaced.  The merged rows are written aside before the target changes.
        """
        spec = self.tables[table]
        staged = pin(self._laid_out(self.conform(df, table), table), "batch")
        keyed, _ = split_null_keys(staged, spec.required)
        winners = latest_per_key(keyed, spec.keys, list(order_by)) if order_by else first_per_key(keyed, spec.keys)
        if grown := self.growing(table):
            return self._upsert_grown(table, grown, staged, winners)
        current = self.read(table)
        before = current.count()
        measures = [
            F.count(F.lit(1)).alias("rows"),
            F.count_if(has_null_key(spec.required)).alias("rejected"),
        ]
        if spec.buckets:
            # At most as many values as the table has buckets.
            measures.append(F.collect_set(BUCKET).alias("touched"))
        offered = staged.agg(*measures).first()
        if offered.rejected:
            self._set_aside(table, staged)
        if spec.buckets:
            current = current.filter(F.col(BUCKET).isin(offered.touched))
        merged = pin(merge_rows(current, winners, spec.keys), "merged")
        self._write(merged.select(*spec.schema.names), table, "overwrite")
        after = self.read(table).count()
        return LoadReport(table, offered.rows, offered.rejected, before, after - before, after)

    def _upsert_grown(self, table: str, grown: GrowingTable, staged: DataFrame, winners: DataFrame) -> LoadReport:
        spec = self.tables[table]
        offered = staged.agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(has_null_key(spec.required)).alias("rejected")
        ).first()
        if offered.rejected:
            self._set_aside(table, staged)
        before = grown.rows_stored()
        added = grown.upsert(winners)
        return LoadReport(table, offered.rows, offered.rejected, before, added, before + added)

    def replace(self, table: str, df: DataFrame, reads_itself: bool = False) -> LoadReport:
        """Truncate and reload.  A frame that reads the table is written aside first."""
        before = self.count(table)
        rows = self.conform(df, table)
        if reads_itself:
            rows = pin(rows, "replacement")
        self._write(rows, table, "overwrite", whole=True)
        after = self.count(table)
        return LoadReport(table, after, 0, before, after, after)
