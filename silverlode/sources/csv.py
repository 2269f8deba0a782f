"""CSV scans with an explicit schema.

Spark applies a CSV schema by position.  Files whose columns are matched by
header name are read as text with the header of the file and then cast, so an
unexpected column order, an extra column or a bad cell cannot shift values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions import lenient_cast

FILE_COLUMN = "_file_name"
#: A row's whole path as Spark's file metadata has it.
URI_COLUMN = "_file_uri"

CSV_OPTIONS = {
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "escape": '"',
    "mode": "PERMISSIVE",
}


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def header_of(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Column names in the header of the first file."""
    return spark.read.options(**CSV_OPTIONS).option("header", True).csv(list(paths)).columns


def cast_by_name(raw: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Expected columns by name, typed; a column the file lacks is NULL, an extra one is dropped."""
    return raw.select(
        *[
            (lenient_cast(F.col(f"`{f.name}`"), f.dataType) if f.name in raw.columns
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ],
        *keep,
    )


def missing_columns(header: Sequence[str], schema: T.StructType) -> list[str]:
    """Expected columns that a file does not deliver."""
    return [name for name in schema.names if name not in header]


def file_name() -> Column:
    """The base name of a scanned row's file; the metadata column has it percent-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def _one_line_records(options: dict[str, str]) -> dict[str, str]:
    """Large files can be split; a record with a wrong number of cells stops the scan."""
    return options | {"multiLine": "false", "mode": "FAILFAST"}


def read_named(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, line_breaks: bool = True, uri: bool = False
) -> DataFrame:
    """Scan CSV files by header name in one job and add the file name (``uri``: also the whole path) of every row.

    All files are expected to share the header of the first; a file that differs
    raises instead of loading shifted values (:func:`read_mixed` takes such sets).
    Quoted cells can hold line breaks, so a file is read by one task; pass
    ``line_breaks=False`` for files known to have none, which are then split.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    names = header_of(spark, paths)
    raw = (
        spark.read.options(**(CSV_OPTIONS if line_breaks else _one_line_records(CSV_OPTIONS)))
        .option("header", True)
        .option("enforceSchema", False)
        .schema(text_schema(names))
        .csv(paths)
        .withColumn(FILE_COLUMN, file_name())
    )
    if not uri:
        return cast_by_name(raw, schema, keep=[FILE_COLUMN])
    return cast_by_name(raw.withColumn(URI_COLUMN, F.col("_metadata.file_path")), schema, keep=[FILE_COLUMN, URI_COLUMN])


def paths_by_header(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """The non-empty files of ``paths`` grouped by their first line."""
    listed = spark.read.format("binaryFile").load(list(paths)).select("path", F.col("_metadata.file_path").alias("_uri"))
    lines = (
        spark.read.text(list(paths))
        .select(
            F.col("_metadata.file_path").alias("_uri"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_id"),
            "value",
        )
        .filter("_block = 0")
    )
    firsts = lines.groupBy("_uri").agg(F.min("_id").alias("_id"))
    groups: dict[str, list[str]] = {}
    for row in lines.join(firsts, ["_uri", "_id"]).join(listed, "_uri").select("value", "path").orderBy("path").collect():
        groups.setdefault(row.value, []).append(row.path)
    return groups


def read_mixed(
    spark: SparkSession, groups: dict[str, list[str]], schema: T.StructType, line_breaks: bool = True, uri: bool = False
) -> DataFrame:
    """Files with different headers, as :func:`paths_by_header` groups them: one scan per header.

    A file without expected columns gives rows of NULLs, which the writers set aside.
    """
    return reduce(DataFrame.unionByName, [read_named(spark, paths, schema, line_breaks, uri) for paths in groups.values()])


def read_positional(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    strict: bool = False,
    line_breaks: bool = True,
) -> DataFrame:
    """Scan CSV files whose columns are matched by position; the header line is skipped.

    Lenient by default (a bad cell is NULL, a missing trailing column is NULL);
    ``strict`` aborts the load on the first malformed row, as a bulk copy does.
    ``line_breaks`` is that of :func:`read_named`.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    options = CSV_OPTIONS if line_breaks else _one_line_records(CSV_OPTIONS)
    reader = spark.read.options(**options).option("header", True).option("recursiveFileLookup", True)
    if strict:
        return reader.option("mode", "FAILFAST").schema(schema).csv(paths)
    raw = reader.schema(text_schema(schema.names)).csv(paths).withColumn("source_file", file_name())
    return cast_by_name(raw, schema, keep=["source_file"])


def write_csv(df: DataFrame, path: str) -> None:
    """Write CSV text that :func:`read_named` reads back unchanged.

    Values go out as Spark's own text, which keeps microseconds and surrounding blanks.
    """
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    text.write.options(**CSV_OPTIONS).option("header", True).csv(path)
