"""Scalar expressions with the exact text, rounding and date rules of the data model."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_TEXT = "NULL"
SEPARATOR = "||"

# --- fixed values: the characters Python's str.strip() removes ---------------------
WHITE_SPACE = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# A run of letters and digits, or a run of anything else.
_WORDS = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


# --- text -----------------------------------------------------------------------
def clean_lower(col: Column) -> Column:
    return F.lower(F.trim(col))


def clean_upper(col: Column) -> Column:
    return F.upper(F.trim(col))


def blank_to_null(col: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(col), F.lit(""))


def capitalize_words(col: Column) -> Column:
    """First letter of every alphanumeric run in upper case, the rest in lower case.

    Spark's ``initcap`` starts a word only after white space; here any character
    that is no letter or digit ends a word (``o'neil st-paul`` -> ``O'Neil St-Paul``).
    """
    pieces = F.regexp_extract_all(F.lower(col), F.lit(_WORDS), F.lit(1))
    raised = F.transform(
        pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))
    )
    return F.array_join(raised, "")


# --- hashes ---------------------------------------------------------------------
# The hashes cover many columns, so they are given by name and built as one SQL
# expression: one call to the JVM instead of several per column.
def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _canonical_text(name: str, dtype: T.DataType) -> str:
    """Text of a value with all white space around it removed; NULL becomes ``NULL``."""
    col = quoted(name)
    text = f"btrim({col}, '{WHITE_SPACE}')" if isinstance(dtype, T.StringType) else f"CAST({col} AS STRING)"
    return f"coalesce({text}, '{NULL_TEXT}')"


def row_hash(fields: Iterable[T.StructField]) -> Column:
    """MD5 of the canonical texts of a row, the lineage hash of every bronze row."""
    texts = ", ".join(_canonical_text(f.name, f.dataType) for f in fields)
    return F.expr(f"md5(concat_ws('{SEPARATOR}', {texts}))")


def joined_hash(names: Iterable[str]) -> Column:
    """MD5 of the values as they are (no trimming), NULL written as ``NULL``."""
    texts = ", ".join(f"coalesce(CAST({quoted(n)} AS STRING), '{NULL_TEXT}')" for n in names)
    return F.expr(f"md5(concat_ws('{SEPARATOR}', {texts}))")


def number_text(col: Column) -> Column:
    """Shortest plain text of a double: ``10`` not ``10.0``, ``12345678.5`` not ``1.23456785E7``.

    Every magnitude is written in plain digits, so different doubles have different texts.
    """
    text = col.cast("string")
    scientific = r"^-?(\d)\.?(\d*?)0*E(-?\d+)$"
    digits = F.concat(F.regexp_extract(text, scientific, 1), F.regexp_extract(text, scientific, 2))
    exponent = F.regexp_extract(text, scientific, 3).try_cast("int")
    # The digits before the decimal point.
    whole = exponent + 1
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -whole), digits)
    padded = F.rpad(digits, whole, F.lit("0"))
    split = F.concat(F.substr(digits, F.lit(1), whole), F.lit("."), F.substr(digits, whole + 1))
    expanded = F.when(exponent < 0, small).when(F.length(digits) > whole, split).otherwise(padded)
    sign = F.when(col < 0, "-").otherwise("")
    plain = F.when(text.endswith(".0"), F.left(text, F.length(text) - 2)).otherwise(text)
    # Texts are scientific below 1e-3 and from 1e7 on only; no pattern is tried in between.
    size = F.abs(col)
    return (
        F.when((size >= 1e-3) & (size < 1e7), plain)
        .when(col == 0, "0")
        .when(text.rlike(scientific), F.concat(sign, expanded))
        .otherwise(plain)
    )


def run_together_hash(cols: Iterable[tuple[Column, T.DataType]]) -> Column:
    """MD5 of the texts with no separator; NULL when any part is NULL."""
    parts = [
        number_text(c) if isinstance(dtype, (T.DoubleType, T.FloatType)) else c.cast("string")
        for c, dtype in cols
    ]
    return F.md5(F.concat(*parts))


# --- numbers --------------------------------------------------------------------
def ratio(numerator: Column, denominator: Column, scale: int, target: str) -> Column:
    """``numerator / denominator`` rounded half away from zero; NULL on a zero denominator.

    Integers are divided as decimals, never as doubles.
    """
    quotient = numerator.cast("decimal(24,2)") / F.nullif(
        denominator.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")
    )
    return F.round(quotient, scale).cast(target)


def rounded_double(col: Column, scale: int, target: str = "decimal(18,2)") -> Column:
    """Round a double's shortest text once, half away from zero; NULL beyond the range of ``target``."""
    return col.try_cast(f"decimal(38,{scale})").try_cast(target)


def sum_or_zero(col: Column, target: str) -> Column:
    return F.coalesce(F.sum(col), F.lit(0)).cast(target)


# --- dates ----------------------------------------------------------------------
def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds between two zone-free timestamps with their fraction, as decimal(18,6)."""
    return (end - start).cast("interval second").cast("decimal(18,6)")


def calendar_parts(day: Column, padded: bool = False) -> dict[str, Column]:
    """Calendar attributes of a date; ISO week, Monday = 1 ... Sunday = 7.

    ``padded`` fills month and day names with blanks to 9 characters, as some SQL
    dialects print them.
    """
    iso_day = (F.weekday(day) + 1).cast("int")

    def name(pattern: str) -> Column:
        text = F.date_format(day, pattern)
        return F.rpad(text, 9, " ") if padded else text

    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": name("MMMM"),
        "week_of_year": F.weekofyear(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": iso_day,
        "day_name": name("EEEE"),
        "is_weekend": iso_day.isin(6, 7),
    }


# --- casts of file text -----------------------------------------------------------
def lenient_cast(col: Column, dtype: T.DataType) -> Column:
    """Cast file text to ``dtype``; a bad cell becomes NULL.

    Whole numbers written with a decimal point (``58.0``) are accepted for
    integer columns and rounded half to even.
    """
    if isinstance(dtype, T.StringType):
        return col
    if isinstance(dtype, (T.IntegerType, T.LongType)):
        rounded = F.bround(col.try_cast("decimal(38,6)"), 0).try_cast(dtype)
        return F.coalesce(col.try_cast(dtype), rounded)
    return col.try_cast(dtype)
