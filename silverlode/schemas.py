"""Table registry: columns, business keys, column defaults and file layout.

Column names, types, keys and defaults are fixed values of the data model, so
they are stated plainly as DDL text.  ``TableSpec.schema`` turns the text into a
``StructType``.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

LINEAGE = "_source_system STRING, _loaded_at TIMESTAMP, _batch_id STRING, _row_hash STRING"
FEED_LINEAGE = (
    "_source_system STRING, _loaded_at TIMESTAMP, _batch_id STRING, _file_name STRING, _row_hash STRING"
)
LINEAGE_NAMES = ("_source_system", "_loaded_at", "_batch_id", "_file_name", "_row_hash")


@dataclass(frozen=True)
class TableSpec:
    """One stored table.

    ``keys`` decide idempotence.  ``defaults`` fill absent or NULL columns.
    ``partition_by`` is ``(new column, source date column)``: files are laid out
    by the month of the source column, so date-bounded readers prune folders.
    ``not_null`` columns are required beside the keys.
    ``buckets`` > 0 gives an upsert table a hash-bucket folder per key group.
    ``bucket_rows`` > 0 stores the table as a :class:`silverlode.sinks.growing.GrowingTable`
    with buckets of at most so many rows; :meth:`growing` asks for it.
    """

    name: str
    columns: str
    keys: tuple[str, ...]
    lineage: str = ""
    defaults: dict[str, object] = field(default_factory=dict)
    partition_by: tuple[str, str] | None = None
    buckets: int = 0
    bucket_rows: int = 0
    not_null: tuple[str, ...] = ()

    @property
    def required(self) -> tuple[str, ...]:
        """Columns whose NULL sets a row aside."""
        return (*self.keys, *(c for c in self.not_null if c not in self.keys))

    def growing(self, bucket_rows: int = 1_000_000) -> TableSpec:
        """This table stored in hash buckets that split, for loads that are small beside the table."""
        return replace(self, partition_by=None, buckets=0, bucket_rows=bucket_rows)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(p for p in (self.columns, self.lineage) if p))

    @property
    def business_schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)

    @property
    def business_columns(self) -> list[str]:
        return self.business_schema.names


# --- fixed values: source tags -------------------------------------------------
SHOP_SOURCE = "kaggle"
PARTNER_SOURCE = "minio"
FX_SOURCE = "frankfurter"
ORDERS_SOURCE = "kaggle+minio"

# --- fixed values: column lists ------------------------------------------------
TRIP_COLUMNS = (
    "vendorid INT, pickup_datetime TIMESTAMP_NTZ, dropoff_datetime TIMESTAMP_NTZ, passenger_count INT, "
    "trip_distance DOUBLE, pickup_longitude DOUBLE, pickup_latitude DOUBLE, ratecodeid INT, "
    "store_and_fwd_flag STRING, dropoff_longitude DOUBLE, dropoff_latitude DOUBLE, payment_type STRING, "
    "fare_amount DOUBLE, extra DOUBLE, mta_tax DOUBLE, tip_amount DOUBLE, tolls_amount DOUBLE, "
    "improvement_surcharge DOUBLE, total_amount DOUBLE"
)
TRIP_HASH_COLUMNS = (
    "vendorid", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance", "fare_amount",
)

ORDERS = (
    "order_id STRING, customer_id STRING, order_status STRING, order_purchase_timestamp TIMESTAMP_NTZ, "
    "order_approved_at TIMESTAMP_NTZ, order_delivered_carrier_date TIMESTAMP_NTZ, "
    "order_delivered_customer_date TIMESTAMP_NTZ, order_estimated_delivery_date TIMESTAMP_NTZ"
)
ORDER_ITEMS = (
    "order_id STRING, order_item_id INT, product_id STRING, seller_id STRING, "
    "shipping_limit_date TIMESTAMP_NTZ, price DECIMAL(12,2), freight_value DECIMAL(12,2), "
    "discount_rate DECIMAL(5,4)"
)
CUSTOMERS = (
    "customer_id STRING, customer_unique_id STRING, customer_zip_code_prefix STRING, "
    "customer_city STRING, customer_state STRING"
)
PRODUCTS_LOADED = (
    "product_id STRING, product_category_name STRING, product_name_lenght INT, "
    "product_description_lenght INT, product_photos_qty INT, product_weight_g DECIMAL(12,2), "
    "product_length_cm DECIMAL(12,2), product_height_cm DECIMAL(12,2), product_width_cm DECIMAL(12,2)"
)
PRODUCTS = (
    PRODUCTS_LOADED
    + ", product_name STRING, product_brand STRING, cost DECIMAL(12,2), price DECIMAL(12,2)"
)
SELLERS = "seller_id STRING, seller_zip_code_prefix STRING, seller_city STRING, seller_state STRING"
ORDER_STATUS = (
    "order_id STRING, status STRING, status_timestamp TIMESTAMP_NTZ, carrier STRING, "
    "tracking_number STRING, warehouse_id STRING, notes STRING, source_system STRING, file_date DATE"
)
RETURNS = (
    "return_id STRING, order_id STRING, product_id STRING, return_date DATE, return_reason STRING, "
    "refund_amount DECIMAL(12,2), refund_currency STRING, return_status STRING, quantity INT, "
    "source_system STRING, file_date DATE"
)
INVENTORY = (
    "product_id STRING, warehouse_id STRING, snapshot_date DATE, quantity_on_hand INT, "
    "quantity_reserved INT, quantity_available INT, reorder_point INT, category STRING, "
    "is_stockout BOOLEAN, source_system STRING, file_date DATE"
)
CURRENCY_RATES = "rate_date DATE, base_currency STRING, target_currency STRING, rate DECIMAL(18,8)"

_SPECS = [
    # --- bronze -----------------------------------------------------------
    TableSpec("bronze.orders", ORDERS, ("order_id",), LINEAGE),
    TableSpec("bronze.order_items", ORDER_ITEMS, ("order_id", "order_item_id"), LINEAGE),
    TableSpec("bronze.customers", CUSTOMERS, ("customer_id",), LINEAGE),
    TableSpec("bronze.products", PRODUCTS, ("product_id",), LINEAGE),
    TableSpec("bronze.sellers", SELLERS, ("seller_id",), LINEAGE),
    TableSpec(
        "bronze.order_payments",
        "order_id STRING, payment_sequential INT, payment_type STRING, payment_installments INT, "
        "payment_value DECIMAL(12,2)",
        ("order_id", "payment_sequential"),
        LINEAGE,
    ),
    TableSpec(
        "bronze.order_reviews",
        "review_id STRING, order_id STRING, review_score INT, review_comment_title STRING, "
        "review_comment_message STRING, review_creation_date TIMESTAMP_NTZ, "
        "review_answer_timestamp TIMESTAMP_NTZ",
        ("review_id",),
        LINEAGE,
    ),
    TableSpec("bronze.order_status", ORDER_STATUS, ("order_id", "status_timestamp", "status"), FEED_LINEAGE),
    TableSpec("bronze.returns", RETURNS, ("return_id",), FEED_LINEAGE),
    TableSpec(
        "bronze.inventory_snapshots", INVENTORY, ("product_id", "warehouse_id", "snapshot_date"), FEED_LINEAGE
    ),
    TableSpec(
        "bronze.currency_rates", CURRENCY_RATES, ("rate_date", "base_currency", "target_currency"), LINEAGE
    ),
    # --- silver -----------------------------------------------------------
    TableSpec("silver.customers", CUSTOMERS, ("customer_id",), LINEAGE),
    TableSpec("silver.products", PRODUCTS, ("product_id",), LINEAGE),
    TableSpec("silver.sellers", SELLERS, ("seller_id",), LINEAGE),
    TableSpec(
        "silver.orders",
        ORDERS
        + ", latest_logistics_status STRING, latest_status_timestamp TIMESTAMP_NTZ, carrier STRING, "
        "tracking_number STRING, warehouse_id STRING, is_delivered BOOLEAN, is_cancelled BOOLEAN, "
        "is_delayed BOOLEAN, delivery_delay_days INT",
        ("order_id",),
        LINEAGE,
    ),
    TableSpec(
        "silver.order_items", ORDER_ITEMS + ", line_total DECIMAL(12,2)", ("order_id", "order_item_id"), LINEAGE
    ),
    TableSpec(
        "silver.returns",
        "return_id STRING, order_id STRING, product_id STRING, return_date DATE, return_reason STRING, "
        "refund_amount DECIMAL(12,2), refund_currency STRING, return_status STRING, quantity INT",
        ("return_id",),
        LINEAGE,
    ),
    TableSpec(
        "silver.inventory",
        "product_id STRING, warehouse_id STRING, snapshot_date DATE, quantity_on_hand INT, "
        "quantity_reserved INT, quantity_available INT, reorder_point INT, category STRING, "
        "is_stockout BOOLEAN",
        ("product_id", "warehouse_id", "snapshot_date"),
        LINEAGE,
    ),
    TableSpec(
        "silver.currency_rates", CURRENCY_RATES, ("rate_date", "base_currency", "target_currency"), LINEAGE
    ),
    # --- gold: dimensions ---------------------------------------------------
    TableSpec(
        "gold.dim_date",
        "date_key DATE, year INT, quarter INT, month INT, month_name STRING, week_of_year INT, "
        "day_of_month INT, day_of_week INT, day_name STRING, is_weekend BOOLEAN",
        ("date_key",),
        not_null=(
            "year", "quarter", "month", "month_name", "day_of_month", "day_of_week", "day_name", "is_weekend",
        ),
    ),
    TableSpec(
        "gold.dim_customers",
        "customer_sk BIGINT, customer_id STRING, customer_unique_id STRING, customer_city STRING, "
        "customer_state STRING, customer_zip_code_prefix STRING",
        ("customer_id",),
        "_loaded_at TIMESTAMP",
    ),
    TableSpec(
        "gold.dim_products",
        "product_sk BIGINT, product_id STRING, product_category_name STRING, "
        "product_weight_g DECIMAL(12,2), product_name STRING, product_brand STRING",
        ("product_id",),
        "_loaded_at TIMESTAMP",
    ),
    # --- gold: facts --------------------------------------------------------
    TableSpec(
        "gold.fact_orders",
        "order_id STRING, customer_id STRING, order_purchase_date DATE, order_status STRING, "
        "latest_logistics_status STRING, carrier STRING, warehouse_id STRING, is_delivered BOOLEAN, "
        "is_cancelled BOOLEAN, is_delayed BOOLEAN, delivery_delay_days INT, order_item_count INT, "
        "order_gross_value DECIMAL(14,2), order_freight_value DECIMAL(14,2), "
        "order_net_value DECIMAL(14,2), has_return BOOLEAN, return_count INT, "
        "total_refund_amount DECIMAL(14,2)",
        ("order_id",),
        "_loaded_at TIMESTAMP",
        defaults={"has_return": False, "return_count": 0, "total_refund_amount": 0},
        partition_by=("order_purchase_month", "order_purchase_date"),
    ),
    TableSpec(
        "gold.fact_order_items",
        "order_id STRING, order_item_id INT, product_id STRING, seller_id STRING, "
        "order_purchase_date DATE, price DECIMAL(12,2), freight_value DECIMAL(12,2), "
        "discount_rate DECIMAL(5,4), line_total DECIMAL(12,2)",
        ("order_id", "order_item_id"),
        "_loaded_at TIMESTAMP",
        partition_by=("order_purchase_month", "order_purchase_date"),
    ),
    TableSpec(
        "gold.fact_returns",
        "return_id STRING, order_id STRING, product_id STRING, return_date DATE, return_reason STRING, "
        "return_status STRING, quantity INT, refund_amount DECIMAL(12,2), refund_currency STRING",
        ("return_id",),
        "_loaded_at TIMESTAMP",
        partition_by=("return_month", "return_date"),
    ),
    # --- gold: KPI tables -----------------------------------------------------
    TableSpec(
        "gold.daily_sales_summary",
        "sales_date DATE, total_orders BIGINT, delivered_orders BIGINT, cancelled_orders BIGINT, "
        "delayed_orders BIGINT, total_items BIGINT, gross_revenue DECIMAL(16,2), net_revenue DECIMAL(16,2), "
        "total_freight DECIMAL(16,2), avg_order_value DECIMAL(12,2), total_returns BIGINT, "
        "total_refund_amount DECIMAL(16,2), return_rate DECIMAL(8,4)",
        ("sales_date",),
        "_loaded_at TIMESTAMP",
    ),
    TableSpec(
        "gold.product_performance",
        "product_id STRING, product_category_name STRING, times_ordered BIGINT, total_quantity_proxy BIGINT, "
        "gross_revenue DECIMAL(16,2), net_revenue DECIMAL(16,2), times_returned BIGINT, "
        "total_refund_amount DECIMAL(16,2), return_rate DECIMAL(8,4)",
        ("product_id",),
        "_loaded_at TIMESTAMP",
    ),
    TableSpec(
        "gold.return_rate_by_reason",
        "return_reason STRING, return_count BIGINT, total_refund_amount DECIMAL(16,2), "
        "pct_of_all_returns DECIMAL(8,4)",
        ("return_reason",),
        "_loaded_at TIMESTAMP",
    ),
    TableSpec(
        "gold.delivery_performance",
        "snapshot_date DATE, total_orders BIGINT, delivered_orders BIGINT, cancelled_orders BIGINT, "
        "delayed_orders BIGINT, delivery_rate DECIMAL(8,4), cancellation_rate DECIMAL(8,4), "
        "delay_rate DECIMAL(8,4), avg_delay_days DECIMAL(8,2)",
        ("snapshot_date",),
        "_loaded_at TIMESTAMP",
    ),
    # --- gold: mergeable sums behind the KPI tables ------------------------------
    TableSpec(
        "gold.daily_sales_partials",
        "sales_date DATE, total_orders BIGINT, delivered_orders BIGINT, cancelled_orders BIGINT, "
        "delayed_orders BIGINT, total_items BIGINT, gross DECIMAL(30,2), net DECIMAL(30,2), freight DECIMAL(30,2), "
        "total_returns BIGINT, refund DECIMAL(30,2), applied_at TIMESTAMP",
        ("sales_date",),
        bucket_rows=1_000,
    ),
    TableSpec(
        "gold.product_partials",
        "product_id STRING, sold BIGINT, gross DECIMAL(30,2), net DECIMAL(30,2), back BIGINT, "
        "refund DECIMAL(30,2), applied_at TIMESTAMP",
        ("product_id",),
        bucket_rows=1_000_000,
    ),
    TableSpec(
        "gold.reason_partials",
        "return_reason STRING, return_count BIGINT, refund DECIMAL(30,2), applied_at TIMESTAMP",
        ("return_reason",),
        bucket_rows=1_000,
    ),
    TableSpec(
        "gold.delivery_partials",
        "scope STRING, total_orders BIGINT, delivered_orders BIGINT, cancelled_orders BIGINT, "
        "delayed_orders BIGINT, delay_days BIGINT, delays BIGINT, applied_at TIMESTAMP",
        ("scope",),
        bucket_rows=1_000,
    ),
    # --- logs -----------------------------------------------------------------
    TableSpec(
        "logs.file_ingestion_log",
        "source_system STRING, file_name STRING, file_path STRING, file_size_bytes BIGINT, "
        "file_checksum STRING, status STRING, rows_loaded BIGINT, rows_inserted BIGINT, "
        "loaded_at TIMESTAMP, run_id STRING",
        ("source_system", "file_name", "file_checksum"),
        buckets=16,
    ),
    TableSpec(
        "logs.data_quality_results",
        "run_id STRING, layer STRING, table_name STRING, check_name STRING, check_type STRING, "
        "status STRING, rows_checked BIGINT, rows_failed BIGINT, failure_percentage DECIMAL(8,4), "
        "details STRING, checked_at TIMESTAMP",
        ("run_id", "table_name", "check_name"),
        buckets=16,
    ),
    TableSpec(
        "logs.pipeline_runs",
        "run_id STRING, dag_id STRING, task_id STRING, source_system STRING, status STRING, "
        "started_at TIMESTAMP, finished_at TIMESTAMP, rows_read BIGINT, rows_inserted BIGINT, "
        "rows_updated BIGINT, rows_skipped BIGINT, error_message STRING, extra_info STRING",
        ("run_id",),
    ),
    # --- taxi -----------------------------------------------------------------
    TableSpec("taxi.trips_raw", TRIP_COLUMNS + ", source_file STRING", ()),
    TableSpec(
        "taxi.trips",
        "trip_hash STRING, " + TRIP_COLUMNS + ", source_file STRING",
        ("trip_hash",),
        "loaded_at TIMESTAMP",
    ),
    TableSpec(
        "taxi.trips_clean",
        "trip_hash STRING, vendorid INT, pickup_datetime TIMESTAMP_NTZ, dropoff_datetime TIMESTAMP_NTZ, "
        "passenger_count INT, trip_distance DOUBLE, payment_type STRING, fare_amount DOUBLE, "
        "tip_amount DOUBLE, total_amount DOUBLE, trip_duration_minutes DECIMAL(18,2), "
        "avg_speed_mph DECIMAL(18,2), tip_percentage DECIMAL(18,2), pickup_hour INT, "
        "pickup_day_of_week STRING, is_weekend BOOLEAN",
        ("trip_hash",),
    ),
    TableSpec(
        "taxi.loaded_files",
        "filename STRING, file_checksum STRING, rows_staged BIGINT, loaded_at TIMESTAMP",
        ("filename",),
        buckets=16,
    ),
    TableSpec(
        "taxi.pipeline_runs",
        "dag_run_id STRING, task_stage STRING, rows_processed BIGINT, status STRING, run_at TIMESTAMP",
        ("dag_run_id", "task_stage"),
    ),
]

TABLES: dict[str, TableSpec] = {spec.name: spec for spec in _SPECS}


@dataclass(frozen=True)
class FileSource:
    """A file set that lands in one bronze table; CSV columns match by header name."""

    location: str
    table: str
    source_system: str
    columns: str

    @property
    def spec(self) -> TableSpec:
        return TABLES[self.table]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)


# One CSV file per table.
SHOP_FILES = (
    FileSource("orders.csv", "bronze.orders", SHOP_SOURCE, ORDERS),
    FileSource("order_items.csv", "bronze.order_items", SHOP_SOURCE, ORDER_ITEMS),
    FileSource("customers.csv", "bronze.customers", SHOP_SOURCE, CUSTOMERS),
    FileSource("products.csv", "bronze.products", SHOP_SOURCE, PRODUCTS_LOADED),
)

# One folder of CSV files per feed.
PARTNER_FEEDS = (
    FileSource("order_status", "bronze.order_status", PARTNER_SOURCE, ORDER_STATUS),
    FileSource("returns", "bronze.returns", PARTNER_SOURCE, RETURNS),
    FileSource("inventory", "bronze.inventory_snapshots", PARTNER_SOURCE, INVENTORY),
)
