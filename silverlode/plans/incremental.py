"""KPI tables kept up to date by the facts of each load, not by all facts.

Every KPI is a function of counts and sums.  These partial sums are stored per day,
product, reason and for delivery as a whole; the sums of a load's facts are added to the
stored ones of the same keys, and ratios are derived when a KPI table is read.  The
partial tables grow by buckets, so a load rewrites the buckets of the keys it touches.

A replaced fact is taken out by subtracting its old values.  ``applied_at`` names the
load that a key saw last: a load that is run again after a crash adds nothing twice,
because its sums appear for all keys at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions import ratio
from silverlode.operators.numbering import pin
from silverlode.operators.reports import share_of_total
from silverlode.plans.gold import KPI_MONEY, RATE
from silverlode.sinks.tables import LoadReport, TableStore

DAILY = "gold.daily_sales_partials"
PRODUCT = "gold.product_partials"
REASON = "gold.reason_partials"
DELIVERY = "gold.delivery_partials"


# --- sums of facts --------------------------------------------------------------------
def daily_sums(orders: DataFrame) -> DataFrame:
    return (
        orders.where("order_purchase_date IS NOT NULL")
        .groupBy(F.col("order_purchase_date").alias("sales_date"))
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.count_if("is_delivered").alias("delivered_orders"),
            F.count_if("is_cancelled").alias("cancelled_orders"),
            F.count_if("is_delayed").alias("delayed_orders"),
            F.sum("order_item_count").alias("total_items"),
            F.sum("order_gross_value").alias("gross"),
            F.sum("order_net_value").alias("net"),
            F.sum("order_freight_value").alias("freight"),
            F.sum("return_count").alias("total_returns"),
            F.sum("total_refund_amount").alias("refund"),
        )
    )


def sold_sums(order_items: DataFrame) -> DataFrame:
    return order_items.where("product_id IS NOT NULL").groupBy("product_id").agg(
        F.count(F.lit(1)).alias("sold"), F.sum("price").alias("gross"), F.sum("line_total").alias("net")
    )


def returned_sums(returned: DataFrame) -> DataFrame:
    return returned.where("product_id IS NOT NULL").groupBy("product_id").agg(
        F.count(F.lit(1)).alias("back"), F.sum("refund_amount").alias("refund")
    )


def reason_sums(returned: DataFrame) -> DataFrame:
    return returned.where("return_reason IS NOT NULL").groupBy("return_reason").agg(
        F.count(F.lit(1)).alias("return_count"), F.sum("refund_amount").alias("refund")
    )


def delivery_sums(orders: DataFrame) -> DataFrame:
    delay = F.when(F.col("is_delayed"), F.col("delivery_delay_days"))
    return orders.groupBy(F.lit("all").alias("scope")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if("is_delivered").alias("delivered_orders"),
        F.count_if("is_cancelled").alias("cancelled_orders"),
        F.count_if("is_delayed").alias("delayed_orders"),
        F.sum(delay).alias("delay_days"),
        F.count(delay).alias("delays"),
    )


# --- merging ----------------------------------------------------------------------------
def negated(sums: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The sums of replaced facts, to be taken out."""
    return sums.select(*[F.col(c) if c in keys else (-F.col(c)).alias(c) for c in sums.columns])


def merge_sums(store: TableStore, table: str, parts: list[DataFrame], loaded_at: datetime) -> LoadReport:
    """Add the sums of one load to the stored ones; keys that saw this load, or a later one, stay as they are."""
    spec = store.tables[table]
    keys = list(spec.keys)
    measures = [c for c in spec.schema.names if c not in (*keys, "applied_at")]
    added = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    absent = [c for c in measures if c not in added.columns]
    delta = added.withColumns({c: F.lit(None) for c in absent}).groupBy(*keys).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast(spec.schema[c].dataType).alias(f"d_{c}") for c in measures]
    )
    delta = pin(delta, "delta")
    grown = store.growing(table)
    stored = grown.near(delta) if grown and store.exists(table) else store.rows(table)
    now = F.lit(loaded_at).cast("timestamp")
    merged = delta.join(stored, keys, "left").where(F.col("applied_at").isNull() | (F.col("applied_at") < now))
    return store.upsert(
        table,
        merged.select(
            *keys, *[(F.coalesce(F.col(c), F.lit(0)) + F.col(f"d_{c}")).alias(c) for c in measures], now.alias("applied_at")
        ),
    )


def _signed(sums, inserted: DataFrame | None, replaced: DataFrame | None, keys: tuple[str, ...]) -> list[DataFrame]:
    parts = [] if inserted is None else [sums(inserted)]
    return parts if replaced is None else [*parts, negated(sums(replaced), keys)]


def apply_orders(
    store: TableStore,
    inserted: DataFrame,
    loaded_at: datetime,
    replaced: DataFrame | None = None,
    tables: Sequence[str] = (DAILY, DELIVERY),
) -> list[LoadReport]:
    """Add the order facts of one load (``replaced``: old rows they overwrite) to the daily and delivery sums."""
    parts = {
        DAILY: lambda: _signed(daily_sums, inserted, replaced, ("sales_date",)),
        DELIVERY: lambda: _signed(delivery_sums, inserted, replaced, ("scope",)),
    }
    return [merge_sums(store, table, parts[table](), loaded_at) for table in tables]


def apply_sales(
    store: TableStore,
    items: DataFrame,
    returned: DataFrame,
    loaded_at: datetime,
    replaced_items: DataFrame | None = None,
    replaced_returns: DataFrame | None = None,
    tables: Sequence[str] = (PRODUCT, REASON),
) -> list[LoadReport]:
    """Add the item and return facts of one load to the product and reason sums."""
    parts = {
        PRODUCT: lambda: _signed(sold_sums, items, replaced_items, ("product_id",))
        + _signed(returned_sums, returned, replaced_returns, ("product_id",)),
        REASON: lambda: _signed(reason_sums, returned, replaced_returns, ("return_reason",)),
    }
    return [merge_sums(store, table, parts[table](), loaded_at) for table in tables]


def apply_stored(store: TableStore, loaded_at: datetime) -> list[LoadReport]:
    """Add the stored facts that a load inserted (those of its ``_loaded_at``)."""
    def loaded(table: str) -> DataFrame:
        return store.rows(table).where(F.col("_loaded_at") == F.lit(loaded_at).cast("timestamp"))

    reports = apply_orders(store, loaded("gold.fact_orders"), loaded_at)
    return reports + apply_sales(store, loaded("gold.fact_order_items"), loaded("gold.fact_returns"), loaded_at)


def rebuild(store: TableStore, loaded_at: datetime) -> None:
    """The sums of all stored facts: for tables that were filled without them."""
    for table in (DAILY, DELIVERY, PRODUCT, REASON):
        store.replace(table, store.rows(table).limit(0))
    orders, items, returned = (store.rows(f"gold.fact_{t}") for t in ("orders", "order_items", "returns"))
    apply_orders(store, orders, loaded_at)
    apply_sales(store, items, returned, loaded_at)


# --- KPI tables from stored sums ----------------------------------------------------------
def _money(name: str, target: str):
    return F.col(name).cast(KPI_MONEY).alias(target)


def daily_sales_summary(store: TableStore) -> DataFrame:
    """As :func:`silverlode.plans.gold.daily_sales_summary` over all facts applied so far."""
    n = F.col("total_orders")
    return store.rows(DAILY).where("total_orders > 0").select(
        "sales_date", "total_orders", "delivered_orders", "cancelled_orders", "delayed_orders", "total_items",
        _money("gross", "gross_revenue"), _money("net", "net_revenue"), _money("freight", "total_freight"),
        ratio(F.col("net"), n, 2, "decimal(12,2)").alias("avg_order_value"),
        "total_returns", _money("refund", "total_refund_amount"),
        ratio(F.col("total_returns"), n, 4, RATE).alias("return_rate"),
    )


def product_performance(store: TableStore, products: DataFrame) -> DataFrame:
    """As :func:`silverlode.plans.gold.product_performance`."""
    def total(name: str, target: str):
        return F.coalesce(F.col(name), F.lit(0)).cast(target)

    sold = F.when(F.col("sold") > 0, F.col("sold"))
    joined = products.select("product_id", "product_category_name").join(store.rows(PRODUCT), "product_id", "left")
    return joined.select(
        "product_id", "product_category_name",
        total("sold", "bigint").alias("times_ordered"), total("sold", "bigint").alias("total_quantity_proxy"),
        total("gross", KPI_MONEY).alias("gross_revenue"), total("net", KPI_MONEY).alias("net_revenue"),
        total("back", "bigint").alias("times_returned"), total("refund", KPI_MONEY).alias("total_refund_amount"),
        F.coalesce(ratio(total("back", "bigint"), sold, 4, RATE), F.lit(0).cast(RATE)).alias("return_rate"),
    )


def return_rate_by_reason(store: TableStore) -> DataFrame:
    """As :func:`silverlode.plans.gold.return_rate_by_reason`."""
    rows = store.rows(REASON).where("return_count > 0")
    return rows.select(
        "return_reason", "return_count", _money("refund", "total_refund_amount"),
        share_of_total(rows, "return_count", 4, RATE).alias("pct_of_all_returns"),
    )


def delivery_performance(store: TableStore, as_of: date) -> DataFrame:
    """As :func:`silverlode.plans.gold.delivery_performance`: one row, zero orders before the first load."""
    sums = store.rows(DELIVERY).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in (
            "total_orders", "delivered_orders", "cancelled_orders", "delayed_orders", "delay_days", "delays")]
    )
    n = F.col("total_orders")
    return sums.select(
        F.lit(as_of).cast("date").alias("snapshot_date"),
        "total_orders", "delivered_orders", "cancelled_orders", "delayed_orders",
        ratio(F.col("delivered_orders"), n, 4, RATE).alias("delivery_rate"),
        ratio(F.col("cancelled_orders"), n, 4, RATE).alias("cancellation_rate"),
        ratio(F.col("delayed_orders"), n, 4, RATE).alias("delay_rate"),
        ratio(F.col("delay_days"), F.col("delays"), 2, "decimal(8,2)").alias("avg_delay_days"),
    )
