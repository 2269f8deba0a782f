"""Source-shaped inputs derived from the given tables.

Each adapter is a projection (or one small join) over a whole table that yields
rows in the shape of a shop file, partner feed, trip file or rate payload, with
the irregularities the pipelines must handle: padded and mixed-case text, NULLs,
duplicate keys, orphans, repeated dates.  ``workload.oracle`` states the same
adapters in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.sources.rates import TARGET_CURRENCIES


class Inputs:
    """Lazy access to the tables of one folder and to the adapters over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # --- shop files -----------------------------------------------------------
    def orders(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "string(o_orderkey) AS order_id",
            "string(o_custkey) AS customer_id",
            "decode(o_orderstatus, 'F', ' Delivered ', 'O', 'shipped', 'Canceled') AS order_status",
            "o_orderdate AS order_purchase_timestamp",
            "o_orderdate + interval 1 hour AS order_approved_at",
            "if(o_orderstatus = 'F', o_orderdate + interval 1 day, NULL) AS order_delivered_carrier_date",
            "if(o_orderstatus = 'F', o_orderdate + make_dt_interval(int(o_orderkey % 15)), NULL)"
            " AS order_delivered_customer_date",
            "o_orderdate + interval 7 days AS order_estimated_delivery_date",
        )

    def order_items(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "string(l_orderkey) AS order_id",
            "l_linenumber AS order_item_id",
            "string(l_partkey) AS product_id",
            "string(l_suppkey) AS seller_id",
            "l_shipdate AS shipping_limit_date",
            "CAST(l_extendedprice AS DECIMAL(12,2)) AS price",
            "CAST(l_quantity AS DECIMAL(12,2)) AS freight_value",
            "CAST(if(l_linenumber = 3, NULL, l_discount) AS DECIMAL(5,4)) AS discount_rate",
        )

    def customers(self) -> DataFrame:
        nation = self.table("nation").selectExpr("n_nationkey AS c_nationkey", "n_name")
        return self.table("customer").join(nation, "c_nationkey").selectExpr(
            "string(c_custkey) AS customer_id",
            "c_name AS customer_unique_id",
            "lpad(string(c_nationkey), 5, '0') AS customer_zip_code_prefix",
            "concat('  ', lower(n_name), '\\' city ') AS customer_city",
            "concat(' ', lower(left(c_mktsegment, 2))) AS customer_state",
        )

    def products(self) -> DataFrame:
        return self.table("part").selectExpr(
            "string(p_partkey) AS product_id",
            "decode(p_type, 'ECONOMY', ' Electronics', 'LARGE', 'Furniture ', 'MEDIUM', 'Fashion',"
            " 'PROMO', 'toys', 'SMALL', 'Home_Goods') AS product_category_name",
            "length(p_name) AS product_name_lenght",
            "int(NULL) AS product_description_lenght",
            "p_size % 5 AS product_photos_qty",
            "CAST(p_size AS DECIMAL(12,2)) AS product_weight_g",
            "CAST(NULL AS DECIMAL(12,2)) AS product_length_cm",
            "CAST(NULL AS DECIMAL(12,2)) AS product_height_cm",
            "CAST(NULL AS DECIMAL(12,2)) AS product_width_cm",
            "p_name AS product_name",
            "p_brand AS product_brand",
            "CAST(NULL AS DECIMAL(12,2)) AS cost",
            "CAST(p_retailprice AS DECIMAL(12,2)) AS price",
        )

    # --- partner feeds ----------------------------------------------------------
    def order_status(self) -> DataFrame:
        moving = "event_type IN ('view', 'click', 'purchase')"
        return self.table("events").selectExpr(
            "if(event_id % 97 = 0, concat('missing-', event_id), string(event_id div 2)) AS order_id",
            "decode(event_type, 'signup', 'pending', 'view', 'shipped', 'click', 'in_transit',"
            " 'purchase', 'Delivered', 'cancelled') AS status",
            "ts AS status_timestamp",
            f"if({moving}, ' UPS ', '') AS carrier",
            f"if({moving}, concat('TRK', user_id), '  ') AS tracking_number",
            "concat('WH-', lpad(string(event_id % 12 + 1), 2, '0')) AS warehouse_id",
            "string(NULL) AS notes",
            "'carrier_hub' AS source_system",
            "date(ts) AS file_date",
        )

    def returns(self) -> DataFrame:
        return self.table("lineitem").filter("l_returnflag = 'R'").selectExpr(
            "concat_ws('-', 'RET', l_orderkey, l_linenumber) AS return_id",
            "string(l_orderkey) AS order_id",
            "string(l_partkey) AS product_id",
            "date(l_shipdate) AS return_date",
            "decode(l_suppkey % 4, 0, ' Defective', 1, 'wrong_item', 2, 'CHANGED_MIND ') AS return_reason",
            "CAST(l_quantity AS DECIMAL(12,2)) AS refund_amount",
            "' usd ' AS refund_currency",
            "'Approved ' AS return_status",
            "1 + l_linenumber % 3 AS quantity",
            "'returns_desk' AS source_system",
            "date(l_shipdate) AS file_date",
        )

    def inventory(self) -> DataFrame:
        return self.table("part").selectExpr(
            "string(p_partkey) AS product_id",
            "concat('WH-', lpad(string(p_partkey % 12 + 1), 2, '0')) AS warehouse_id",
            "explode(array(date'2024-01-15', date'2024-02-15')) AS snapshot_date",
            "p_size * 11 % 600 AS quantity_on_hand",
            "int(p_partkey % 20) AS quantity_reserved",
            "p_size * 11 % 600 - int(p_partkey % 20) AS quantity_available",
            "int(10 + p_partkey % 90) AS reorder_point",
            "' Toys ' AS category",
            "p_size * 11 % 600 <= p_partkey % 20 AS is_stockout",
            "'warehouse' AS source_system",
        ).withColumn("file_date", F.col("snapshot_date"))

    # --- taxi files -------------------------------------------------------------
    def trips(self) -> DataFrame:
        """Every event as a trip of ``a.csv``; purchases are delivered again in ``b.csv``."""
        return self.table("events").selectExpr(
            "int(if(event_id % 101 = 0, NULL, 1 + event_id % 2)) AS vendorid",
            "ts AS pickup_datetime",
            "ts + make_dt_interval(0, 0, 0, floor(value * 10) - 5) AS dropoff_datetime",
            "int(user_id % 6) AS passenger_count",
            "value / 8 AS trip_distance",
            "double(NULL) AS pickup_longitude",
            "double(NULL) AS pickup_latitude",
            "1 AS ratecodeid",
            "'N' AS store_and_fwd_flag",
            "double(NULL) AS dropoff_longitude",
            "double(NULL) AS dropoff_latitude",
            "if(event_id % 2 = 0, 'cash', 'card') AS payment_type",
            "if(event_id % 53 = 0, -value, value) AS fare_amount",
            "double(0.5) AS extra",
            "double(0.5) AS mta_tax",
            "value / 4 AS tip_amount",
            "double(0) AS tolls_amount",
            "double(0.3) AS improvement_surcharge",
            "value * 2 AS total_amount",
            "explode(if(event_type = 'purchase', array('a.csv', 'b.csv'), array('a.csv'))) AS source_file",
        )

    # --- exchange rates -----------------------------------------------------------
    def payloads(self) -> DataFrame:
        """One JSON payload per event day.

        Weekend payloads carry the preceding Friday's date, as a rate service does on
        non-trading days; payloads of the 15th carry none.
        """
        slot = F.col("event_id") % len(TARGET_CURRENCIES)
        quotes = self.table("events").groupBy(F.to_date("ts").alias("requested_date")).agg(
            *[
                F.max(F.when(slot == i, F.round(F.col("value") * 100))).cast("bigint").alias(code)
                for i, code in enumerate(TARGET_CURRENCIES)
            ]
        )
        day = F.col("requested_date")
        weekend = F.greatest(F.weekday(day) - 4, F.lit(0))
        quoted = F.when(F.dayofmonth(day) != 15, F.date_sub(day, weekend))
        rates = F.struct(
            *[
                (F.col(code).cast("decimal(14,0)") * F.lit("0.0001").cast("decimal(5,4)")).alias(code)
                for code in TARGET_CURRENCIES
            ]
        )
        return quotes.select(
            "requested_date",
            F.to_json(F.struct(quoted.alias("date"), F.lit("USD").alias("base"), rates.alias("rates"))).alias(
                "payload"
            ),
        )

    # --- file listings ------------------------------------------------------------
    def daily_files(self, delivered: Column | None = None) -> DataFrame:
        """One listing row per event day as if each day were a file.

        ``delivered`` selects the rows a file held at listing time; the checksum
        covers exactly those rows.
        """
        events = self.table("events")
        if delivered is not None:
            events = events.filter(delivered)
        digest = F.concat_ws(
            "|",
            F.count(F.lit(1)).cast("string"),
            F.sum("event_id").cast("string"),
            F.sum(F.round(F.col("value") * 100).cast("bigint")).cast("string"),
        )
        return (
            events.groupBy(F.to_date("ts").alias("day"))
            .agg(F.count(F.lit(1)).alias("rows_loaded"), F.md5(digest).alias("file_checksum"))
            .select(
                F.lit("partner").alias("source_system"),
                F.concat(F.lit("events_"), F.date_format("day", "yyyyMMdd"), F.lit(".csv")).alias("file_name"),
                "file_checksum",
                "rows_loaded",
            )
        )
