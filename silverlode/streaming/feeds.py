"""File-arrival stream: new CSV files of a feed go to bronze with insert-if-absent.

The checkpoint remembers which paths were read.  De-duplication is against the
bronze table, not stream state, so state does not grow with the stream.  A batch
that is replayed after a failure inserts nothing twice.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from silverlode.plans.bronze import with_lineage
from silverlode.schemas import FileSource
from silverlode.sinks.tables import TableStore
from silverlode.sources import csv


def stream_feed(
    store: TableStore,
    feed: FileSource,
    folder: str,
    checkpoint: str,
    loaded_at: datetime,
    max_files_per_batch: int = 1000,
) -> int:
    """Read every file that arrived since the last call, then stop; returns the stored row count."""
    header = csv.header_of(store.spark, [folder])
    raw = (
        store.spark.readStream.options(**csv.CSV_OPTIONS)
        .option("header", True)
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .schema(csv.text_schema(header))
        .csv(folder)
        .withColumn(csv.FILE_COLUMN, csv.file_name())
    )
    rows = csv.cast_by_name(raw, feed.schema, keep=[csv.FILE_COLUMN])

    def write(batch: DataFrame, batch_number: int) -> None:
        batch_id = f"{feed.location}_stream_{batch_number}"
        landed = with_lineage(batch, feed.table, feed.source_system, batch_id, loaded_at)
        store.insert_if_absent(feed.table, landed)

    query = (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return store.read(feed.table).count()
