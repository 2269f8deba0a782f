"""Bronze to silver: trimmed and conformed values, delivery flags, line totals.

Every transform is a narrow projection except ``orders``, which looks up the
latest partner status per order.  Bronze keys are unique and silver keeps them,
so only ``currency_rates`` (whose key columns change case here) needs a new key
winner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions import blank_to_null, capitalize_words, clean_lower, clean_upper, joined_hash
from silverlode.operators.keyed import first_per_key, latest_per_key
from silverlode.schemas import FX_SOURCE, ORDERS_SOURCE, PARTNER_SOURCE, SHOP_SOURCE


def _lineage(source_system: str, *hashed: str) -> dict:
    """The silver hash covers the bronze values as delivered, before cleaning."""
    return {
        "_source_system": F.lit(source_system),
        "_row_hash": joined_hash(hashed),
    }


def customers(bronze: DataFrame) -> DataFrame:
    cleaned = {
        "customer_city": capitalize_words(F.trim("customer_city")),
        "customer_state": clean_upper(F.col("customer_state")),
    }
    hashed = (
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
    )
    return bronze.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        *[c.alias(n) for n, c in {**cleaned, **_lineage(SHOP_SOURCE, *hashed)}.items()],
    )


def products(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "product_id",
        clean_lower(F.col("product_category_name")).alias("product_category_name"),
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "product_name",
        "product_brand",
        "cost",
        "price",
        *[c.alias(n) for n, c in _lineage(SHOP_SOURCE, "product_id", "product_category_name").items()],
    )


def latest_status(order_status: DataFrame) -> DataFrame:
    """The last partner status of each order; equal timestamps fall to the greater status text."""
    return latest_per_key(
        order_status.select(
            "order_id", "status_timestamp", "status", "carrier", "tracking_number", "warehouse_id"
        ),
        ["order_id"],
        ["status_timestamp", "status"],
    )


def orders(bronze_orders: DataFrame, order_status: DataFrame) -> DataFrame:
    status = latest_status(order_status).select(
        "order_id",
        F.col("status").alias("latest_logistics_status"),
        F.col("status_timestamp").alias("latest_status_timestamp"),
        blank_to_null(F.col("carrier")).alias("carrier"),
        blank_to_null(F.col("tracking_number")).alias("tracking_number"),
        "warehouse_id",
    )
    own = clean_lower(F.col("order_status"))
    partner = F.lower("latest_logistics_status")
    delivered_on = F.to_date("order_delivered_customer_date")
    promised_on = F.to_date("order_estimated_delivery_date")
    delay = F.datediff(delivered_on, promised_on)

    def flag(condition):
        return F.coalesce(condition, F.lit(False))

    return bronze_orders.join(status, "order_id", "left").select(
        "order_id",
        "customer_id",
        own.alias("order_status"),
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "latest_logistics_status",
        "latest_status_timestamp",
        "carrier",
        "tracking_number",
        "warehouse_id",
        (flag(own == "delivered") | flag(partner == "delivered")).alias("is_delivered"),
        (flag(own.isin("canceled", "cancelled")) | flag(partner == "cancelled")).alias("is_cancelled"),
        flag(delay > 0).alias("is_delayed"),
        delay.alias("delivery_delay_days"),
        *[
            c.alias(n)
            for n, c in _lineage(ORDERS_SOURCE, "order_id", "customer_id", "order_status").items()
        ],
    )


def order_items(bronze: DataFrame) -> DataFrame:
    discount = F.coalesce("discount_rate", F.lit(0)).cast("decimal(5,4)")
    line_total = F.round(F.col("price") * (F.lit(1) - discount), 2).cast("decimal(12,2)")
    return bronze.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
        discount.alias("discount_rate"),
        line_total.alias("line_total"),
        *[
            c.alias(n)
            for n, c in _lineage(SHOP_SOURCE, "order_id", "order_item_id", "product_id").items()
        ],
    )


def returns(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "return_id",
        "order_id",
        "product_id",
        "return_date",
        clean_lower(F.col("return_reason")).alias("return_reason"),
        "refund_amount",
        clean_upper(F.col("refund_currency")).alias("refund_currency"),
        clean_lower(F.col("return_status")).alias("return_status"),
        "quantity",
        *[c.alias(n) for n, c in _lineage(PARTNER_SOURCE, "return_id", "order_id", "product_id").items()],
    )


def inventory(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "product_id",
        "warehouse_id",
        "snapshot_date",
        "quantity_on_hand",
        "quantity_reserved",
        "quantity_available",
        "reorder_point",
        clean_lower(F.col("category")).alias("category"),
        "is_stockout",
        *[
            c.alias(n)
            for n, c in _lineage(PARTNER_SOURCE, "product_id", "warehouse_id", "snapshot_date").items()
        ],
    )


def currency_rates(bronze: DataFrame) -> DataFrame:
    lineage = _lineage(FX_SOURCE, "rate_date", "base_currency", "target_currency", "rate")
    cleaned = bronze.select(
        "rate_date",
        clean_upper(F.col("base_currency")).alias("base_currency"),
        clean_upper(F.col("target_currency")).alias("target_currency"),
        "rate",
        *[c.alias(n) for n, c in lineage.items()],
    )
    return first_per_key(cleaned, ["rate_date", "base_currency", "target_currency"])
