"""One runnable query per operator and per table of the model."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from silverlode.operators import (
    absent_from,
    check_references,
    check_rules,
    first_per_key,
    merge_rows,
    pin,
    run_checks,
    running_delta,
    summarize,
    update_columns,
)
from silverlode.operators.constraints import check, not_null, split_rows
from silverlode.plans import bronze, dashboard, gold, incremental, silver, taxi
from silverlode.plans.checks import BRONZE_REFERENCES, BRONZE_RULES
from silverlode.plans.jobs import load_feeds
from silverlode.schemas import FX_SOURCE, PARTNER_FEEDS, PARTNER_SOURCE, SHOP_SOURCE, TABLES
from silverlode.session import scratch_path
from silverlode.sinks.tables import TableStore
from silverlode.sources import csv, csv_blocks, files, inference, rates
from silverlode.streaming.feeds import stream_feed
from workload.adapters import Inputs

AS_OF = date(2024, 6, 30)
PERIOD = (date(1995, 1, 1), date(1998, 12, 31))
# Items shipped before this day form the first load of the insert-if-absent query.
FIRST_LOAD_BEFORE = "1998-01-01"
LOADED_AT = datetime(2024, 7, 1)


class Model(Inputs):
    """All layers of the e-commerce model and the taxi model as lazy frames."""

    # bronze
    def bronze_orders(self):
        return bronze.land(self.orders(), "bronze.orders", SHOP_SOURCE)

    def bronze_order_items(self):
        return bronze.land(self.order_items(), "bronze.order_items", SHOP_SOURCE)

    def bronze_customers(self):
        return bronze.land(self.customers(), "bronze.customers", SHOP_SOURCE)

    def bronze_products(self):
        return bronze.land(self.products(), "bronze.products", SHOP_SOURCE)

    def bronze_order_status(self):
        return bronze.land(self.order_status(), "bronze.order_status", PARTNER_SOURCE)

    def bronze_returns(self):
        return bronze.land(self.returns(), "bronze.returns", PARTNER_SOURCE)

    def bronze_inventory(self):
        return bronze.land(self.inventory(), "bronze.inventory_snapshots", PARTNER_SOURCE)

    def bronze_currency_rates(self):
        return bronze.land(rates.flatten_payloads(self.payloads()), "bronze.currency_rates", FX_SOURCE)

    # silver
    def silver_customers(self):
        return silver.customers(self.bronze_customers())

    def silver_products(self):
        return silver.products(self.bronze_products())

    def silver_orders(self):
        return silver.orders(self.bronze_orders(), self.bronze_order_status())

    def silver_order_items(self):
        return silver.order_items(self.bronze_order_items())

    def silver_returns(self):
        return silver.returns(self.bronze_returns())

    def silver_inventory(self):
        return silver.inventory(self.bronze_inventory())

    def silver_currency_rates(self):
        return silver.currency_rates(self.bronze_currency_rates())

    # gold
    def dim_date(self):
        return gold.dim_date(self.silver_orders())

    def dim_customers(self):
        return gold.dim_customers(self.silver_customers())

    def dim_products_named(self):
        return gold.name_products(gold.product_rows(self.silver_products()))

    def stored_order_dates(self):
        """What the item facts read from the stored silver orders."""
        return pin(self.silver_orders().select("order_id", "order_purchase_timestamp"), "silver-orders")

    def fact_order_items(self):
        return gold.fact_order_items(self.silver_order_items(), self.stored_order_dates())

    def fact_orders(self):
        return gold.fact_orders(self.silver_orders(), self.silver_order_items(), self.silver_returns())

    def fact_returns(self):
        return gold.fact_returns(self.silver_returns())

    def daily_sales_summary(self):
        return gold.daily_sales_summary(self.fact_orders())

    def product_performance(self):
        return gold.product_performance(
            gold.product_rows(self.silver_products()), self.fact_order_items(), self.fact_returns()
        )

    def return_rate_by_reason(self):
        return gold.return_rate_by_reason(self.fact_returns())

    def delivery_performance(self):
        return gold.delivery_performance(self.fact_orders(), AS_OF)

    def gold_tables(self):
        """The tables a dashboard needs; the KPI tables read the stored order facts."""
        facts = pin(self.fact_orders(), "fact-orders")
        return {
            "gold.fact_orders": facts,
            "gold.daily_sales_summary": gold.daily_sales_summary(facts),
            "gold.product_performance": self.product_performance(),
            "gold.delivery_performance": gold.delivery_performance(facts, AS_OF),
        }

    def landed(self):
        """Source rows under their bronze table names, before key de-duplication, some of them against the rules."""
        orders = self.orders().withColumns(
            {
                "order_id": F.expr("if(order_id LIKE '%77', NULL, order_id)"),
                "order_purchase_timestamp": F.expr("if(order_id LIKE '%55', NULL, order_purchase_timestamp)"),
            }
        )
        items = self.order_items().withColumns(
            {
                "product_id": F.expr("if(order_item_id = 7, NULL, product_id)"),
                "price": F.expr("CASE WHEN order_id LIKE '%31' THEN -price WHEN order_id NOT LIKE '%32' THEN price END"),
            }
        )
        rate = F.expr("if(target_currency = 'JPY', -rate, rate)")
        return {
            "bronze.orders": orders,
            "bronze.order_items": items,
            "bronze.customers": self.customers(),
            "bronze.products": self.products(),
            "bronze.order_status": self.order_status(),
            "bronze.returns": self.returns(),
            "bronze.currency_rates": rates.flatten_payloads(self.payloads()).withColumn("rate", rate),
        }

    # taxi
    def taxi_stage(self):
        return taxi.stage(self.trips())

    def taxi_trips(self):
        return taxi.trips(self.taxi_stage())

    def taxi_clean(self):
        return taxi.clean(self.taxi_trips())


def _without(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def _landed_columns(df: DataFrame) -> DataFrame:
    """Load time and batch id belong to the run, not to the data."""
    return _without(df, "_loaded_at", "_batch_id")


# --- sources ----------------------------------------------------------------------
CUSTOMER_FILE = "c_custkey BIGINT, c_name STRING, c_acctbal DECIMAL(12,2), c_mktsegment STRING, c_phone STRING"


def csv_scan_typed(m: Model) -> DataFrame:
    """Customers written as CSV with some balances spoilt, read back by header name."""
    spoilt = m.table("customer").select(
        "c_mktsegment",
        "c_custkey",
        F.when(F.col("c_custkey") % 100 == 0, "n/a")
        .otherwise(F.col("c_acctbal").cast("decimal(12,2)").cast("string"))
        .alias("c_acctbal"),
        F.expr("if(c_custkey % 7 = 0, concat(c_name, '\\n\"x\", y'), c_name)").alias("c_name"),
        F.lit("x").alias("unexpected"),
    )
    path = scratch_path(m.spark, "csv-scan")
    csv.write_csv(spoilt, path)
    return csv.read_named(m.spark, path, StructType.fromDDL(CUSTOMER_FILE)).drop(csv.FILE_COLUMN)


ITEM_FILE = "l_orderkey BIGINT, l_linenumber INT, note STRING, l_extendedprice DECIMAL(12,2), l_shipdate DATE"


def csv_parallel(m: Model) -> DataFrame:
    """Items written as CSV, every fifth with a note of three lines, read back by blocks."""
    noted = m.table("lineitem").selectExpr(
        "l_shipdate",
        "if(l_linenumber = 5, concat('item \\n\\n\"', l_linenumber, '\", of ', l_orderkey), if(l_linenumber = 6, NULL, 'plain')) AS note",
        "l_linenumber",
        "CAST(l_extendedprice AS DECIMAL(12,2)) AS l_extendedprice",
        "l_orderkey",
    )
    path = scratch_path(m.spark, "csv-parallel")
    csv.write_csv(noted, path)
    return csv_blocks.read_named(m.spark, path, StructType.fromDDL(ITEM_FILE)).drop(csv.FILE_COLUMN)


MIXED_ORDERS = {
    "key": "string(o_orderkey)",
    "big": "string(o_orderkey * 10000000000)",
    "price": "string(CAST(o_totalprice AS DECIMAL(12,2)))",
    "share": "if(o_orderkey % 50 = 3, concat(o_custkey, 'E-3'), string(CAST(o_totalprice AS DECIMAL(12,2))))",
    "day": "if(o_orderkey % 3 = 0, NULL, date_format(o_orderdate, 'yyyy-MM-dd'))",
    "moment": "if(o_orderkey % 4 = 0, date_format(o_orderdate, 'yyyy-MM-dd'), date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss'))",
    "late_text": "if(o_orderkey = 7, 'n/a', string(o_custkey))",
    "zip": "lpad(string(o_custkey), 8, '0')",
    "no_day": "if(o_orderkey % 2 = 0, '2023-02-30', '2023-02-28')",
    "status": "o_orderstatus",
    "nothing": "string(NULL)",
}


def csv_infer_types(m: Model) -> DataFrame:
    """Types of orders written as CSV: whole columns decide, down to one odd cell."""
    path = scratch_path(m.spark, "csv-infer")
    csv.write_csv(m.table("orders").selectExpr(*[f"{sql} AS {name}" for name, sql in MIXED_ORDERS.items()]), path)
    texts = csv.read_named(m.spark, path, csv.text_schema(list(MIXED_ORDERS)))
    return inference.profile_types(texts, list(MIXED_ORDERS))


def taxi_stage_csv(m: Model) -> DataFrame:
    """Trip files read by position and by blocks, then filtered; a bad distance is a NULL that drops its row."""
    trips = m.trips().withColumn(
        "trip_distance", F.expr("if(passenger_count = 1 AND vendorid = 2, 'far', string(trip_distance))")
    )
    path = scratch_path(m.spark, "trip-files")
    csv.write_csv(trips.drop("source_file"), path)
    schema = StructType([f for f in TABLES["taxi.trips_raw"].schema if f.name != "source_file"])
    return taxi.stage(csv_blocks.read_positional(m.spark, path, schema)).select(*TRIP_OUTPUT[:-1])


def file_fingerprint(m: Model) -> DataFrame:
    """Fingerprints of the orders written as one file of ordered lines per month."""
    path = scratch_path(m.spark, "fingerprint")
    lines = m.table("orders").selectExpr(
        "date_format(o_orderdate, 'yyyy-MM') AS month",
        "o_orderkey",
        "concat_ws(',', o_orderkey, o_custkey, o_orderstatus) AS line",
    )
    ordered = lines.repartition("month").sortWithinPartitions("month", "o_orderkey")
    ordered.select("month", "line").write.partitionBy("month").text(path)
    found = files.fingerprints(m.spark, path, "*.txt")
    return found.select(
        F.regexp_extract("path", "month=([0-9-]+)", 1).alias("month"), "file_size_bytes", "file_checksum"
    )


def _write_feeds(m: Model) -> str:
    landing = scratch_path(m.spark, "landing")
    for name, frame in (
        ("order_status", m.order_status()),
        ("returns", m.returns()),
        ("inventory", m.inventory()),
    ):
        csv.write_csv(frame, f"{landing}/{name}")
    return landing


def feed_ingest(m: Model) -> DataFrame:
    """All partner feeds from CSV files, loaded twice; the second run must add nothing."""
    landing = _write_feeds(m)
    store = TableStore(m.spark, scratch_path(m.spark, "store"))
    first = load_feeds(store, landing, "run-1", LOADED_AT)
    second = load_feeds(store, landing, "run-2", LOADED_AT)
    return first.select(
        F.col("source").alias("feed"), "table_name", "status", "rows_inserted"
    ).join(
        second.select(
            F.col("source").alias("feed"),
            F.col("reason").alias("second_run"),
            F.col("rows_inserted").alias("rows_inserted_again"),
        ),
        "feed",
    )


def feed_rows(m: Model) -> DataFrame:
    """The returns feed after its round trip through CSV files, as stored in bronze."""
    path = scratch_path(m.spark, "returns-feed")
    csv.write_csv(m.returns(), path)
    feed = next(f for f in PARTNER_FEEDS if f.location == "returns")
    rows = csv.read_named(m.spark, path, feed.schema)
    return _landed_columns(bronze.land(rows.drop(csv.FILE_COLUMN), feed.table, feed.source_system))


def stream_feed_ingest(m: Model) -> DataFrame:
    """The status feed through the file-arrival stream; reports the stored rows by status."""
    path = scratch_path(m.spark, "status-feed")
    csv.write_csv(m.order_status(), path)
    feed = next(f for f in PARTNER_FEEDS if f.location == "order_status")
    store = TableStore(m.spark, scratch_path(m.spark, "store"))
    stream_feed(store, feed, path, scratch_path(m.spark, "stream-checkpoint"), LOADED_AT)
    return store.rows(feed.table).groupBy("status").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("status_timestamp").alias("last_change")
    )


def fx_flatten(m: Model) -> DataFrame:
    return rates.flatten_payloads(m.payloads())


def json_flatten(m: Model) -> DataFrame:
    flat = rates.flatten_object(m.table("events"), ["event_id"], "props")
    return flat.select("event_id", "key", F.col("value").cast("bigint").alias("value"))


def _order_days(m: Model) -> DataFrame:
    return m.table("orders").select(F.to_date("o_orderdate").alias("date")).distinct()


def date_spine(m: Model) -> DataFrame:
    days = _order_days(m)
    return rates.date_spine(days.agg(F.min("date").alias("start"), F.max("date").alias("end")))


def missing_dates(m: Model) -> DataFrame:
    """Days of the order period on which no urgent order was placed."""
    urgent = (
        m.table("orders")
        .filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P"))
        .select(F.to_date("o_orderdate").alias("date"))
        .distinct()
    )
    return rates.missing_dates(date_spine(m), urgent)


# --- sinks -------------------------------------------------------------------------
def insert_if_absent(m: Model) -> DataFrame:
    """Rows a second load adds after items shipped before a cut-off were loaded first."""
    items = m.order_items()
    stored = items.filter(F.col("shipping_limit_date") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz"))
    keys = TABLES["bronze.order_items"].keys
    return absent_from(first_per_key(items, keys), first_per_key(stored, keys), keys)


def insert_twice(m: Model) -> DataFrame:
    """Load reports of two overlapping inserts into a stored table."""
    items = m.order_items()
    early = items.filter(F.col("shipping_limit_date") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz"))
    store = TableStore(m.spark, scratch_path(m.spark, "store"))
    reports = [
        (number, r.rows_attempted, r.rows_before, r.rows_inserted, r.rows_after)
        for number, r in (
            (1, store.insert_if_absent("bronze.order_items", early)),
            (2, store.insert_if_absent("bronze.order_items", items)),
        )
    ]
    return m.spark.createDataFrame(
        reports,
        "load INT, rows_attempted BIGINT, rows_before BIGINT, rows_inserted BIGINT, rows_after BIGINT",
    )


def _first_delivery(m: Model) -> DataFrame:
    """What the day files held before the late error events arrived."""
    return m.daily_files(F.col("event_type") != "error")


def upsert_manifest(m: Model) -> DataFrame:
    """The file log after a first delivery and a complete one, keyed by file name."""
    first = _first_delivery(m).withColumn("run_id", F.lit("run-1"))
    second = m.daily_files().withColumn("run_id", F.lit("run-2"))
    return merge_rows(first, second, ["source_system", "file_name"])


def upsert_stored(m: Model) -> DataFrame:
    """The same deliveries upserted into the stored, bucketed log keyed by name and checksum."""
    store = TableStore(m.spark, scratch_path(m.spark, "store"))
    log = "logs.file_ingestion_log"
    for run, frame in (("run-1", _first_delivery(m)), ("run-2", m.daily_files()), ("run-3", m.daily_files())):
        store.upsert(log, frame.withColumns({"run_id": F.lit(run), "status": F.lit("processed")}))
    return store.rows(log).select("source_system", "file_name", "file_checksum", "rows_loaded", "run_id")


def new_files_only(m: Model) -> DataFrame:
    """Day files to load when the first delivery was processed, except its failed Mondays."""
    day = F.to_date(F.substring("file_name", 8, 8), "yyyyMMdd")
    manifest = _first_delivery(m).withColumn(
        "status", F.when(F.weekday(day) == 0, "failed").otherwise("processed")
    )
    redelivered = m.daily_files(F.col("event_type") != "error").unionByName(m.daily_files())
    return files.changed_files(redelivered, manifest)


ITEM_CONSTRAINTS = [
    *not_null("order_id", "product_id", "price", "discount_rate"),
    check("price_positive", "price > 0"),
    check("freight_below_price", "freight_value <= price"),
]


def constraint_split(m: Model) -> DataFrame:
    """Failures per item constraint among the rows set aside, and how many rows went each way."""
    kept, rejected = split_rows(m.landed()["bronze.order_items"], ITEM_CONSTRAINTS)
    failed = rejected.select(F.explode("_failed").alias("constraint_name")).groupBy("constraint_name").agg(
        F.count(F.lit(1)).alias("rows_failed")
    )
    sizes = {f"rows_{n}": df.agg(F.count(F.lit(1))).scalar() for n, df in (("kept", kept), ("rejected", rejected))}
    return failed.select("constraint_name", "rows_failed", *[size.alias(name) for name, size in sizes.items()])


def _growing_store(m: Model, table: str, bucket_rows: int) -> TableStore:
    return TableStore(m.spark, scratch_path(m.spark, "store"), {table: TABLES[table].growing(bucket_rows)})


def upsert_growing(m: Model) -> DataFrame:
    """Order items in buckets of at most 20,000 rows after three upserts: early items, all of them, and repriced ones."""
    table = "bronze.order_items"
    store = _growing_store(m, table, 20_000)
    items = pin(m.order_items(), "items")
    early = items.filter(F.col("shipping_limit_date") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz"))
    repriced = items.filter("order_id LIKE '%7'").withColumn("price", F.expr("CAST(price * 2 AS DECIMAL(12,2))"))
    for batch in (early, items, repriced):
        store.upsert(table, batch)
    return store.rows(table).select("order_id", "order_item_id", "product_id", "price")


def insert_absent_filtered(m: Model) -> DataFrame:
    """As ``insert_if_absent``, against a stored table whose fragments are found through filters of their keys."""
    table = "bronze.order_items"
    store = _growing_store(m, table, 20_000)
    items = m.order_items()
    early = items.filter(F.col("shipping_limit_date") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz"))
    store.insert_if_absent(table, early)
    staged = store.stage(table, items)
    fresh = pin(store.fresh_rows(table, staged), "fresh")
    store.insert_fresh(table, staged, fresh)
    return fresh.select(*items.columns)


def _in_batches(m: Model, facts: dict[str, DataFrame], apply, table: str) -> TableStore:
    """A store whose sums in ``table`` got the facts in three loads, split by order."""
    store = TableStore(m.spark, scratch_path(m.spark, "store"))
    stored = {name: pin(rows, name) for name, rows in facts.items()}
    for number in range(3):
        batch = {n: rows.filter(F.pmod(F.crc32("order_id"), F.lit(3)) == number) for n, rows in stored.items()}
        apply(store, **batch, loaded_at=LOADED_AT + timedelta(days=number), tables=[table])
    return store


def _orders_in_batches(m: Model, table: str) -> TableStore:
    return _in_batches(m, {"inserted": m.fact_orders()}, incremental.apply_orders, table)


def _sales_in_batches(m: Model, table: str) -> TableStore:
    # Only what the sums and the split by order need is stored.
    facts = {
        "items": m.fact_order_items().select("order_id", "product_id", "price", "line_total"),
        "returned": m.fact_returns().select("order_id", "product_id", "return_reason", "refund_amount"),
    }
    return _in_batches(m, facts, incremental.apply_sales, table)


def daily_sales_incremental(m: Model) -> DataFrame:
    return incremental.daily_sales_summary(_orders_in_batches(m, incremental.DAILY))


def delivery_incremental(m: Model) -> DataFrame:
    return incremental.delivery_performance(_orders_in_batches(m, incremental.DELIVERY), AS_OF)


def product_performance_incremental(m: Model) -> DataFrame:
    products = gold.product_rows(m.silver_products())
    return incremental.product_performance(_sales_in_batches(m, incremental.PRODUCT), products)


def return_rate_incremental(m: Model) -> DataFrame:
    return incremental.return_rate_by_reason(_sales_in_batches(m, incremental.REASON))


def update_from(m: Model) -> DataFrame:
    """List prices raised to the highest price sold; products never sold keep theirs."""
    sold = m.order_items().groupBy("product_id").agg(F.max("price").alias("price"))
    return update_columns(m.products().select("product_id", "product_name", "price"), sold, ["product_id"], ["price"])


def load_delta(m: Model) -> DataFrame:
    counts = m.trips().groupBy("source_file").agg(F.count(F.lit(1)).alias("added"))
    return running_delta(counts, "source_file", "added")


# --- quality -----------------------------------------------------------------------
def _results(df: DataFrame) -> DataFrame:
    return df.select(
        "table_name", "check_name", "check_type", "status", "rows_checked", "rows_failed", "failure_percentage"
    )


def dq_bronze(m: Model) -> DataFrame:
    return _results(run_checks(m.landed(), BRONZE_RULES, BRONZE_REFERENCES))


def dq_orphans(m: Model) -> DataFrame:
    return _results(check_references(m.landed(), BRONZE_REFERENCES))


def dq_summary(m: Model) -> DataFrame:
    return summarize(run_checks(m.landed(), BRONZE_RULES, BRONZE_REFERENCES))


def taxi_dq(m: Model) -> DataFrame:
    loaded = pin(m.taxi_trips(), "trips")
    return _results(taxi.gate_trips(loaded).unionByName(taxi.gate_clean(taxi.clean(loaded))))


# --- taxi ----------------------------------------------------------------------------
TRIP_OUTPUT = [
    "vendorid", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
    "payment_type", "fare_amount", "tip_amount", "total_amount", "source_file",
]


def taxi_dedup(m: Model) -> DataFrame:
    return m.taxi_trips().select("trip_hash", *TRIP_OUTPUT)


def taxi_rejects(m: Model) -> DataFrame:
    return taxi.rejects(m.taxi_stage()).select(*TRIP_OUTPUT[1:])


# --- dashboard -------------------------------------------------------------------------
def dash_top_products(m: Model) -> DataFrame:
    """Reads the product dimension and its KPI table as stored, as a dashboard does."""
    named = pin(m.dim_products_named(), "dim-products")
    performance = gold.product_performance(named, m.fact_order_items(), m.fact_returns())
    return dashboard.top_products(pin(performance, "product-performance"), named)


QUERIES: dict[str, Callable[[Model], DataFrame]] = {
    # sources
    "csv_scan_typed": csv_scan_typed,
    "csv_parallel": csv_parallel,
    "csv_infer_types": csv_infer_types,
    "file_fingerprint": file_fingerprint,
    "feed_ingest": feed_ingest,
    "feed_rows": feed_rows,
    "stream_feed_ingest": stream_feed_ingest,
    "fx_flatten": fx_flatten,
    "json_flatten": json_flatten,
    "date_spine": date_spine,
    "missing_dates": missing_dates,
    # sinks
    "insert_if_absent": insert_if_absent,
    "insert_twice": insert_twice,
    "upsert_manifest": upsert_manifest,
    "upsert_stored": upsert_stored,
    "upsert_growing": upsert_growing,
    "insert_absent_filtered": insert_absent_filtered,
    "new_files_only": new_files_only,
    "update_from": update_from,
    "load_delta": load_delta,
    # taxi
    "taxi_stage": lambda m: m.taxi_stage().select(*TRIP_OUTPUT),
    "taxi_stage_csv": taxi_stage_csv,
    "taxi_dedup": taxi_dedup,
    "taxi_rejects": taxi_rejects,
    "taxi_clean": lambda m: m.taxi_clean(),
    "taxi_dq": taxi_dq,
    # bronze
    "bronze_orders": lambda m: _landed_columns(m.bronze_orders()),
    "bronze_order_items": lambda m: _landed_columns(m.bronze_order_items()),
    "bronze_customers": lambda m: _landed_columns(m.bronze_customers()),
    "bronze_products": lambda m: _landed_columns(m.bronze_products()),
    "bronze_currency_rates": lambda m: _landed_columns(m.bronze_currency_rates()),
    # silver
    "latest_status": lambda m: silver.latest_status(m.bronze_order_status()),
    "silver_customers": lambda m: m.silver_customers(),
    "silver_products": lambda m: m.silver_products(),
    "silver_orders": lambda m: m.silver_orders(),
    "silver_order_items": lambda m: m.silver_order_items(),
    "silver_returns": lambda m: m.silver_returns(),
    "silver_inventory": lambda m: m.silver_inventory(),
    "silver_currency_rates": lambda m: m.silver_currency_rates(),
    # gold
    "dim_date": lambda m: m.dim_date(),
    "dim_customers": lambda m: m.dim_customers(),
    "dim_products_named": lambda m: m.dim_products_named(),
    "fact_order_items": lambda m: m.fact_order_items(),
    "fact_orders": lambda m: m.fact_orders(),
    "fact_returns": lambda m: m.fact_returns(),
    "daily_sales_summary": lambda m: m.daily_sales_summary(),
    "product_performance": lambda m: m.product_performance(),
    "return_rate_by_reason": lambda m: m.return_rate_by_reason(),
    "delivery_performance": lambda m: m.delivery_performance(),
    "daily_sales_incremental": daily_sales_incremental,
    "delivery_incremental": delivery_incremental,
    "product_performance_incremental": product_performance_incremental,
    "return_rate_incremental": return_rate_incremental,
    # dashboard
    "dash_date_bounds": lambda m: dashboard.date_bounds(m.daily_sales_summary()),
    "dash_kpis": lambda m: dashboard.period_kpis(m.daily_sales_summary(), *PERIOD),
    "dash_daily": lambda m: dashboard.daily_trend(m.daily_sales_summary(), *PERIOD),
    "dash_top_products": dash_top_products,
    "dash_reasons": lambda m: dashboard.return_reasons(m.return_rate_by_reason()),
    "dash_delivery": lambda m: dashboard.latest_delivery(m.delivery_performance()),
    "dash_categories": lambda m: dashboard.top_categories(m.product_performance()),
    # quality
    "dq_bronze": dq_bronze,
    "dq_orphans": dq_orphans,
    "dq_summary": dq_summary,
    "constraint_split": constraint_split,
    "table_counts": lambda m: dashboard.table_counts(m.gold_tables()),
    "readiness": lambda m: dashboard.readiness(m.gold_tables()),
}


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES[name](Model(spark, folder))
