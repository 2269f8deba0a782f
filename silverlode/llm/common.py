"""Reading tables, storing intermediate results and streaming grouped Arrow rows."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from silverlode.session import scratch_path

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROWS_PER_BATCH = 1000
BYTES_PER_BATCH = "8m"  # whatever the rows: long texts come in small batches, or alone


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches keep Python workers small; local workers find this package.

    On a cluster the package is installed on the executors or shipped with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    if spark.sparkContext.master.startswith("local[") and root not in environment.get("PYTHONPATH", ""):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, environment.get("PYTHONPATH")]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_PER_BATCH)


def quoted(names: Iterable[str]) -> list[str]:
    """Column names as they can be selected, dots and all."""
    return ["`" + name.replace("`", "``") + "`" for name in names]


def unused(df: DataFrame, *names: str) -> list[str]:
    """The given names, each with underscores behind it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table by its Parquet path."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a copy that outlives executors.

    The shuffle files of the write go at its end, not when the driver's heap is full.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Give memory that is not in use back to the system, as far as the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``; a worker that waits for its next task, or for none, keeps no memory of the last one."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    return tidied


def keyed_groups(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str]
) -> Iterator[pa.Table]:
    """Tables of equal ``keys`` from batches sorted by these (non-null integer) columns."""
    open_parts: list[pa.RecordBatch] = []
    open_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        starts = [0]
        change = columns[0][1:] != columns[0][:-1]
        for column in columns[1:]:
            change |= column[1:] != column[:-1]
        starts += (change.nonzero()[0] + 1).tolist()
        for start, end in zip(starts, starts[1:] + [batch.num_rows]):
            key = tuple(column[start] for column in columns)
            if open_parts and key != open_key:
                yield pa.Table.from_batches(open_parts)
                open_parts = []
            open_key = key
            open_parts.append(batch.slice(start, end - start))
    if open_parts:
        yield pa.Table.from_batches(open_parts)
