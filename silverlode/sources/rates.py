"""Exchange-rate payloads (JSON objects) to rows, and the dates they should cover."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: base currency, targets, lookback -------------------------------
BASE_CURRENCY = "USD"
TARGET_CURRENCIES = ("EUR", "GBP", "CAD", "AUD", "JPY", "INR", "MXN", "BRL")
LOOKBACK_DAYS = 30

PAYLOAD_SCHEMA = "date DATE, rates MAP<STRING, DECIMAL(18,8)>"


def flatten_payloads(payloads: DataFrame, base: str = BASE_CURRENCY) -> DataFrame:
    """One row per (payload, currency) from (requested_date, payload JSON).

    The payload's own date wins; without one the requested date is used.  Missing
    ``rates`` give no rows.
    """
    parsed = payloads.select("requested_date", F.from_json("payload", PAYLOAD_SCHEMA).alias("p"))
    return parsed.select(
        F.coalesce("p.date", "requested_date").alias("rate_date"),
        F.lit(base).alias("base_currency"),
        F.explode("p.rates").alias("target_currency", "rate"),
    )


def flatten_object(df: DataFrame, keep: list[str], column: str) -> DataFrame:
    """Entries of a JSON object column with numeric values as (key, value) rows."""
    return df.select(*keep, F.explode(F.from_json(column, "map<string,double>")).alias("key", "value"))


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Landed payload files, one JSON object each, named ``<requested date>.json``."""
    return spark.read.option("wholetext", True).text(folder).select(
        F.regexp_extract(F.col("_metadata.file_name"), r"(\d{4}-\d{2}-\d{2})", 1)
        .try_cast("date")
        .alias("requested_date"),
        F.col("value").alias("payload"),
    )


def date_spine(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Every date from ``start`` to ``end`` inclusive, from one row of bounds."""
    return bounds.select(
        F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias("date")
    )


def default_bounds(spark: SparkSession, today: date, lookback: int = LOOKBACK_DAYS) -> DataFrame:
    return spark.createDataFrame([(today - timedelta(days=lookback), today)], "start DATE, end DATE")


def missing_dates(spine: DataFrame, present: DataFrame) -> DataFrame:
    """Dates of the spine with no row in ``present``."""
    return spine.join(present.select("date"), "date", "left_anti")
