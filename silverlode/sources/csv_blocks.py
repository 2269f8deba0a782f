"""Parallel CSV scans of large files whose quoted cells may hold line breaks.

A line feed inside quotes ends no record, and whether a line starts inside quotes
depends on every quote before it.  Only the parity of these quotes matters, so it is
found in two passes over splittable line scans:

1. count the lines with an odd number of quotes per block of a file; a running sum over
   the blocks (one row each) tells which blocks start inside quotes;
2. blocks that start outside quotes and hold no such line ("quiet" blocks) are records
   line by line and are parsed where they are read.  In the others a running parity over
   the block's lines finds where records start; the lines of a record that spans lines, or
   blocks, are joined by the place of its first line.  Lines are shuffled by a number that
   stands for their block, without the names of files.

Escaped quotes are doubled, so they leave the parity alone.  A quote in a cell that is
not quoted would break it; every record with quotes is therefore checked, and a stray
quote or a file that ends inside quotes raises an error instead of shifting records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.operators.numbering import pin
from silverlode.sources.csv import CSV_OPTIONS, FILE_COLUMN, URI_COLUMN, cast_by_name, header_of, text_schema

_MIN_PARTITIONS = "spark.sql.files.minPartitionNum"
_BLOCK = ["_uri", "_block", "_length"]


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Every line with its file, block and place; ``_odd`` says that it opens or closes a quote."""
    # Both passes must cut the files alike, also when executors come or go in between.
    if spark.conf.get(_MIN_PARTITIONS, None) is None:
        spark.conf.set(_MIN_PARTITIONS, str(spark.sparkContext.defaultParallelism))
    quotes = "octet_length(value) - octet_length(replace(value, '\"', ''))"
    return (
        spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(list(paths))
        .select(
            F.col("_metadata.file_path").alias("_uri"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.col("_metadata.file_block_length").alias("_length"),
            F.monotonically_increasing_id().alias("_seq"),
            "value",
            F.expr(f"cast(({quotes}) % 2 as int)").alias("_odd"),
        )
    )


def block_states(lines: DataFrame) -> DataFrame:
    """Per block: its lines, its first line, whether it starts inside quotes and whether it is quiet.

    A block that starts inside quotes goes on with the record that line ``_carry`` opened.
    """
    counts = lines.groupBy(*_BLOCK).agg(
        F.count(F.lit(1)).alias("_lines"), F.sum("_odd").alias("_toggles"), F.min("_seq").alias("_first"),
        F.max(F.when(F.col("_odd") == 1, F.col("_seq"))).alias("_last_odd"),
    )
    earlier = Window.partitionBy("_uri").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("_toggles").over(earlier), F.lit(0)) % 2
    return (
        counts.withColumns({"_inside": inside.cast("int"), "_carry": F.last("_last_odd", ignorenulls=True).over(earlier)})
        .withColumn("_quiet", F.expr("_inside = 0 and _toggles = 0"))
        .drop("_last_odd")
    )


#: A block of the second pass that the first pass did not see means that the files were cut differently.
_QUIET = "if(_quiet is null, raise_error('the files changed, or were cut differently, while they were read'), _quiet)"


def _started(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Lines of blocks that are not quiet, with the line that starts their record; ``_head`` marks a file's first line."""
    upto = Window.partitionBy("_first").orderBy("_seq")
    before = F.coalesce(F.sum("_odd").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = F.max(F.when(F.col("_open") == 0, F.col("_seq"))).over(upto.rowsBetween(Window.unboundedPreceding, 0))
    return (
        lines.join(states.where("not _quiet").select(*_BLOCK, "_first", "_inside", "_carry"), _BLOCK)
        .select("_first", "_block", "_seq", "_inside", "_carry", "value", "_odd")
        .withColumn("_open", (F.col("_inside") + before) % 2)
        # Lines before the first record of a block carry on the last record of the blocks before.
        .withColumn("_start", F.coalesce(start, "_carry"))
        .withColumn("_head", F.expr("_block = 0 and _seq = _first"))
    )


def records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(_uri, _header, _text): the records of CSV files as text, empty ones left out.

    The order is that of no file; ``_header`` marks the first record of each.
    """
    lines = _lines(spark, [paths] if isinstance(paths, str) else paths)
    states = pin(block_states(lines), "csv-blocks")
    # The text is made NULL and not filtered, so later checks of it cannot move below the joins to other lines.
    whole = lines.join(states.select(*_BLOCK, "_first", "_quiet"), _BLOCK, "left").select(
        "_uri", F.expr("_block = 0 and _seq = _first").alias("_header"), F.expr(f"if({_QUIET}, value, null)").alias("_text")
    )
    if not states.where("not _quiet").isEmpty():
        started = _started(lines, states)
        # Both parts use all columns of the shuffled lines, so one shuffle serves them.
        alone = F.expr("if(_open = 0 and _odd = 0 and _start is not null, value, null) AS _text")
        single = started.select("_first", F.col("_head").alias("_header"), alone)
        # A record's own lines: as many as its cells have line feeds.
        joined = started.where("_open = 1 or _odd = 1").groupBy("_start").agg(
            F.max("_first").alias("_first"), F.max("_head").alias("_header"),
            F.sort_array(F.collect_list(F.struct("_block", "_seq", "value"))).alias("_parts"),
        ).select("_first", "_header", F.expr("array_join(transform(_parts, p -> p.value), '\\n')"))
        noisy = single.union(joined).join(states.select("_first", "_uri"), "_first")
        whole = whole.union(noisy.select("_uri", "_header", "_text"))
    text = F.expr("if(right(_text, 1) = '\\r', left(_text, char_length(_text) - 1), _text)")
    return whole.withColumn("_text", text).where("_text <> ''").withColumn("_text", _well_quoted("_text"))


def _well_quoted(column: str) -> Column:
    """The record, or an error: what stands between two quoted cells must start and end with a comma.

    Cut at the quotes, every second part lies outside of them; an empty one is an escaped quote.
    """
    last = f"(size(split({column}, '\"')) - 1)"
    outside = (
        f"transform(split({column}, '\"'), (x, i) -> i % 2 = 1 or x = ''"
        f" or ((i = 0 or startswith(x, ',')) and (i = {last} or endswith(x, ','))))"
    )
    return F.expr(
        f"case when {column} is null or instr({column}, '\"') = 0 then {column}"
        f" when {last} % 2 = 0 and forall({outside}, x -> x) then {column}"
        f" else raise_error(concat('a quote outside of a quoted cell, or a file that ends inside one, in ', _uri)) end"
    )


def _cells(found: DataFrame, count: int, mode: str) -> DataFrame:
    schema = ", ".join(f"c{i} STRING" for i in range(count))
    options = {**CSV_OPTIONS, "mode": mode}
    return found.withColumn("_cells", F.from_csv("_text", schema, options))


def read_named(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, uri: bool = False) -> DataFrame:
    """As :func:`silverlode.sources.csv.read_named`, with files of any size read by many tasks."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    names = header_of(spark, paths)
    cells = _cells(records(spark, paths), len(names), "PERMISSIVE")
    expected = F.array(*[F.lit(n) for n in names])
    same = F.array(*[F.coalesce(F.col(f"_cells.c{i}"), F.lit(n)) for i, n in enumerate(names)]) == expected
    other = F.raise_error(F.concat(F.lit("a header differs from that of the first file: "), F.col("_uri")))
    rows = cells.where(F.when(F.col("_header"), F.when(same, F.lit(False)).otherwise(other)).otherwise(F.lit(True)))
    raw = rows.select(
        *[F.col(f"_cells.c{i}").alias(n) for i, n in enumerate(names)],
        F.url_decode(F.replace(F.element_at(F.split("_uri", "/"), -1), F.lit("+"), F.lit("%2B"))).alias(FILE_COLUMN),
        F.col("_uri").alias(URI_COLUMN),
    )
    return cast_by_name(raw, schema, keep=[FILE_COLUMN, URI_COLUMN] if uri else [FILE_COLUMN])


def read_positional(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, strict: bool = False
) -> DataFrame:
    """As :func:`silverlode.sources.csv.read_positional`, with files of any size read by many tasks."""
    found = records(spark, paths).where("not _header")
    if strict:
        options = {**CSV_OPTIONS, "mode": "FAILFAST"}
        parsed = found.withColumn("_cells", F.from_csv("_text", schema.simpleString()[7:-1].replace(":", " "), options))
        return parsed.select("_cells.*")
    cells = _cells(found, len(schema), "PERMISSIVE")
    raw = cells.select(
        *[F.col(f"_cells.c{i}").alias(n) for i, n in enumerate(schema.names)],
        F.url_decode(F.replace(F.element_at(F.split("_uri", "/"), -1), F.lit("+"), F.lit("%2B"))).alias("source_file"),
    )
    return cast_by_name(raw, schema, keep=["source_file"])
