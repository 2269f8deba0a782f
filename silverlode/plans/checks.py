"""The bronze quality rules: fixed values (tables, names, predicates, severities)."""

from __future__ import annotations

from silverlode.operators.quality import NULL_CHECK, RANGE, VOLUME, Reference, Rule

BRONZE_RULES = (
    Rule("bronze.orders", "null_order_id", NULL_CHECK, True, "order_id IS NULL"),
    Rule("bronze.orders", "null_purchase_timestamp", NULL_CHECK, True, "order_purchase_timestamp IS NULL"),
    Rule("bronze.order_items", "null_order_id", NULL_CHECK, True, "order_id IS NULL"),
    Rule("bronze.order_items", "null_product_id", NULL_CHECK, True, "product_id IS NULL"),
    Rule("bronze.customers", "null_customer_id", NULL_CHECK, True, "customer_id IS NULL"),
    Rule("bronze.products", "null_product_id", NULL_CHECK, True, "product_id IS NULL"),
    Rule("bronze.returns", "null_return_id", NULL_CHECK, True, "return_id IS NULL"),
    Rule("bronze.returns", "null_return_date", NULL_CHECK, True, "return_date IS NULL"),
    Rule("bronze.currency_rates", "null_rate_date", NULL_CHECK, True, "rate_date IS NULL"),
    Rule("bronze.order_items", "negative_or_null_price", RANGE, True, "price IS NULL OR price < 0"),
    Rule("bronze.currency_rates", "non_positive_rate", RANGE, True, "rate IS NULL OR rate <= 0"),
    Rule("bronze.orders", "empty_table", VOLUME, False),
    Rule("bronze.order_items", "empty_table", VOLUME, False),
    Rule("bronze.order_status", "empty_table", VOLUME, False),
    Rule("bronze.returns", "empty_table", VOLUME, False),
    Rule("bronze.currency_rates", "empty_table", VOLUME, False),
)

BRONZE_REFERENCES = (
    Reference("bronze.order_items", "bronze.orders", "order_id"),
    Reference("bronze.returns", "bronze.orders", "order_id"),
    Reference("bronze.order_status", "bronze.orders", "order_id"),
)
