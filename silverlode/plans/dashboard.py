"""Report queries over the gold layer; dates are typed parameters, never query text."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions import sum_or_zero
from silverlode.operators.reports import top_rows

TOP_PRODUCTS = 15
TOP_CATEGORIES = 12
# --- fixed values: the gold tables a dashboard needs ------------------------------
REQUIRED_TABLES = (
    "gold.fact_orders", "gold.daily_sales_summary", "gold.product_performance", "gold.delivery_performance",
)


def _in_period(start: date, end: date) -> Column:
    return F.col("sales_date").between(F.lit(start), F.lit(end))


def date_bounds(daily: DataFrame) -> DataFrame:
    return daily.agg(F.min("sales_date").alias("min_d"), F.max("sales_date").alias("max_d"))


def period_kpis(daily: DataFrame, start: date, end: date) -> DataFrame:
    """Totals of a period (both ends included) and their ratios; zero when there are no orders."""
    totals = daily.filter(_in_period(start, end)).agg(
        sum_or_zero(F.col("total_orders"), "bigint").alias("total_orders"),
        sum_or_zero(F.col("net_revenue"), "decimal(26,2)").alias("net_revenue"),
        sum_or_zero(F.col("gross_revenue"), "decimal(26,2)").alias("gross_revenue"),
        sum_or_zero(F.col("total_returns"), "bigint").alias("total_returns"),
        sum_or_zero(F.col("total_refund_amount"), "decimal(26,2)").alias("total_refunds"),
        sum_or_zero(F.col("delivered_orders"), "bigint").alias("delivered_orders"),
        sum_or_zero(F.col("cancelled_orders"), "bigint").alias("cancelled_orders"),
        sum_or_zero(F.col("delayed_orders"), "bigint").alias("delayed_orders"),
    )

    def per_order(name: str) -> Column:
        quotient = F.col(name).cast("double") / F.nullif(F.col("total_orders"), F.lit(0).cast("bigint"))
        return F.coalesce(quotient, F.lit(0.0))

    return totals.withColumns(
        {
            "avg_order_value": per_order("net_revenue"),
            "return_rate": per_order("total_returns"),
            "delivery_rate": per_order("delivered_orders"),
        }
    )


def daily_trend(daily: DataFrame, start: date, end: date) -> DataFrame:
    return (
        daily.filter(_in_period(start, end))
        .select("sales_date", "net_revenue", "gross_revenue", "total_orders", "avg_order_value", "return_rate")
        .orderBy("sales_date")
    )


def top_products(performance: DataFrame, products: DataFrame, k: int = TOP_PRODUCTS) -> DataFrame:
    """Best sellers by net revenue, labelled by name or by the first 8 characters of the id.

    The top ``k`` rows are taken first; only their ids look up a label, so both
    broadcasts below hold at most ``k`` rows.
    """
    best = top_rows(
        performance.select(
            "product_id", "product_category_name", "net_revenue", "times_ordered", "return_rate"
        ),
        [F.col("net_revenue").desc_nulls_last(), F.col("product_id")],
        k,
    )
    labels = products.select("product_id", "product_name").join(
        F.broadcast(best.select("product_id")), "product_id", "left_semi"
    )
    return (
        best.join(F.broadcast(labels), "product_id", "left")
        .select(
            F.coalesce("product_name", F.left("product_id", F.lit(8))).alias("product_label"),
            "product_id",
            "product_category_name",
            "net_revenue",
            "times_ordered",
            "return_rate",
        )
        .orderBy(F.col("net_revenue").desc_nulls_last(), "product_id")
    )


def return_reasons(reasons: DataFrame) -> DataFrame:
    return reasons.select(
        "return_reason", "return_count", "total_refund_amount", "pct_of_all_returns"
    ).orderBy(F.col("return_count").desc_nulls_first(), "return_reason")


def latest_delivery(performance: DataFrame) -> DataFrame:
    return top_rows(performance, [F.col("snapshot_date").desc_nulls_first()], 1)


def top_categories(performance: DataFrame, k: int = TOP_CATEGORIES) -> DataFrame:
    totals = performance.groupBy(
        F.coalesce("product_category_name", F.lit("unknown")).alias("category")
    ).agg(
        F.sum("net_revenue").cast("decimal(26,2)").alias("net_revenue"),
        F.sum("times_ordered").cast("bigint").alias("times_ordered"),
        F.sum("times_returned").cast("bigint").alias("times_returned"),
    )
    return top_rows(totals, [F.col("net_revenue").desc_nulls_last(), F.col("category")], k)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, one row each."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counted[0]
    for frame in counted[1:]:
        result = result.unionByName(frame)
    return result


def readiness(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Whether each table a dashboard needs has at least one row; reads one row per table."""
    probes = [
        df.select(F.lit(1)).limit(1).agg((F.count(F.lit(1)) > 0).alias("is_ready")).select(
            F.lit(name).alias("table_name"), "is_ready"
        )
        for name, df in tables.items()
    ]
    result = probes[0]
    for frame in probes[1:]:
        result = result.unionByName(frame)
    return result
