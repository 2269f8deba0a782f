"""Column types inferred from all rows of a text table, in one pass.

The types form a lattice: an integer is also a decimal, a decimal a double, a date a
timestamp, and everything is text.  Counting per column how many values each type can
hold, with the greatest numbers of digits, is a mergeable aggregate: blocks and files are
counted apart and added up, and the narrowest type that holds every value is read off.
No prefix of the rows decides, so a value far down a file cannot turn into a NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions import quoted
from silverlode.sources import csv, csv_blocks

#: Numbers with leading zeros are text: a cast would lose the zeros of codes.  So are plain
#: numbers of over 38 digits, which a double would round.
INTEGER = r"^[+-]?(0|[1-9][0-9]*)$"
DECIMAL = r"^[+-]?(0|[1-9][0-9]*)([.][0-9]+)?$"
DOUBLE = r"^[+-]?(0|[1-9][0-9]*)([.][0-9]+)?([eE][+-]?[0-9]+)?$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?)?$"

_MEASURES = ("n_values", "n_integers", "n_decimals", "n_doubles", "n_dates", "n_timestamps", "whole_digits", "scale")


def _measures(name: str) -> list[str]:
    """SQL aggregates of one text column, in the order of ``_MEASURES``."""
    c = quoted(name)
    decimal = f"{c} rlike '{DECIMAL}'"
    whole = f"char_length(regexp_replace(split_part({c}, '.', 1), '[+-]', ''))"
    return [
        f"count({c})",
        f"count_if({c} rlike '{INTEGER}')",
        f"count_if({decimal})",
        f"count_if({c} rlike '{DOUBLE}')",
        f"count_if({c} rlike '{DATE}' AND try_cast({c} AS DATE) IS NOT NULL)",
        f"count_if({c} rlike '{TIMESTAMP}' AND try_cast({c} AS TIMESTAMP_NTZ) IS NOT NULL)",
        f"coalesce(max(if({decimal}, {whole}, 0)), 0)",
        f"coalesce(max(if({decimal}, char_length(split_part({c}, '.', 2)), 0)), 0)",
    ]


_TYPE = """CASE WHEN n_values = 0 THEN 'void'
    WHEN n_integers = n_values AND whole_digits <= 9 THEN 'int'
    WHEN n_integers = n_values AND whole_digits <= 18 THEN 'bigint'
    WHEN n_decimals = n_values AND whole_digits + scale <= 38 THEN concat('decimal(', whole_digits + scale, ',', scale, ')')
    WHEN n_decimals = n_values THEN 'string'
    WHEN n_doubles = n_values THEN 'double'
    WHEN n_dates = n_values THEN 'date'
    WHEN n_timestamps = n_values THEN 'timestamp_ntz'
    ELSE 'string' END"""


def profile_types(texts: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, data_type, n_rows, n_values) for text columns; a column without values is ``void``."""
    names = list(columns if columns is not None else texts.columns)
    wide = [f"{sql} AS m{i}_{k}" for i, name in enumerate(names) for k, sql in enumerate(_measures(name))]
    counted = texts.selectExpr(*[quoted(n) for n in names]).agg(
        *[F.expr(sql) for sql in ["count(1) AS n_rows", *wide]]
    )
    entries = ", ".join(
        "struct('{}' AS column_name, {})".format(
            name.replace("\\", "\\\\").replace("'", "\\'"), ", ".join(f"cast(m{i}_{k} AS BIGINT) AS {m}" for k, m in enumerate(_MEASURES))
        )
        for i, name in enumerate(names)
    )
    long = counted.selectExpr("n_rows", f"inline(array({entries}))")
    return long.selectExpr("column_name", f"{_TYPE} AS data_type", "n_rows", "n_values")


def infer_schema(texts: DataFrame, columns: Sequence[str] | None = None) -> T.StructType:
    """The narrowest types that hold every value; columns without values are text."""
    found = {r.column_name: r.data_type for r in profile_types(texts, columns).collect()}
    names = list(columns if columns is not None else texts.columns)
    return T.StructType([
        T.StructField(n, T.StringType() if found[n] == "void" else T.DataType.fromDDL(found[n])) for n in names
    ])


def read_inferred(spark: SparkSession, paths: str | Sequence[str], parallel: bool = False) -> DataFrame:
    """CSV files of one header with inferred types and the file name of every row; no cell is lost to its type."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    read = csv_blocks.read_named if parallel else csv.read_named
    names = csv.header_of(spark, paths)
    texts = read(spark, paths, csv.text_schema(names))
    return csv.cast_by_name(texts, infer_schema(texts, names), keep=[csv.FILE_COLUMN])
