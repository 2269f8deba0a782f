"""Silver to gold: star schema and KPI tables.

One-to-many sides are aggregated before they meet an order or a product, which
keeps the row count right (two one-to-many joins would multiply) and lets the map
side shrink hot keys before any shuffle.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions import calendar_parts, ratio, sum_or_zero
from silverlode.operators.numbering import number_rows, pin
from silverlode.operators.reports import share_of_total

MONEY = "decimal(14,2)"
KPI_MONEY = "decimal(16,2)"
RATE = "decimal(8,4)"

# --- fixed values: product names per category ------------------------------------
PRODUCT_NAMES = {
    "electronics": [
        "Laptop Pro", "Tablet Air", "Smartphone X", "Wireless Earbuds", "4K Monitor", "Gaming Mouse",
        "Mechanical Keyboard", "Bluetooth Speaker", "USB-C Hub", "Webcam HD", "Power Bank", "Smartwatch",
        "External SSD", "WiFi Router", "Graphics Card", "Portable Charger",
        "Noise Cancelling Headphones", "Smart TV Stick",
    ],
    "fashion": [
        "Classic T-Shirt", "Slim Jeans", "Running Sneakers", "Leather Jacket", "Summer Dress", "Hoodie",
        "Canvas Backpack", "Wool Scarf", "Baseball Cap", "Casual Shirt", "Ankle Boots", "Denim Jacket",
        "Chino Pants", "Knit Sweater", "Raincoat", "Sports Shorts", "Leather Belt", "Sunglasses",
    ],
    "home_goods": [
        "Table Lamp", "Ceramic Vase", "Throw Pillow", "Wall Clock", "Coffee Maker", "Nonstick Pan",
        "Storage Bin", "Area Rug", "Desk Organizer", "Scented Candle", "Cutlery Set", "Bedsheet Set",
        "Kitchen Scale", "Laundry Basket", "Soap Dispenser", "Photo Frame", "Trash Can",
        "Water Bottle Set",
    ],
    "furniture": [
        "Office Chair", "Wooden Desk", "Bookshelf", "Sofa Set", "Dining Table", "Bed Frame", "TV Stand",
        "Wardrobe", "Side Table", "Recliner", "Shoe Rack", "Coffee Table", "Nightstand", "Bar Stool",
        "Filing Cabinet", "Accent Chair", "Console Table", "Ottoman",
    ],
    "toys": [
        "Building Blocks", "Remote Car", "Puzzle Set", "Action Figure", "Board Game", "Plush Toy",
        "LEGO Kit", "RC Helicopter", "Art Set", "Yo-Yo Pro", "Science Kit", "Doll House", "Train Set",
        "Slime Kit", "Stuffed Animal", "Card Game", "Robot Toy", "Water Gun",
    ],
    "books": [
        "Mystery Novel", "Data Engineering Guide", "Sci-Fi Classic", "Cookbook Essentials",
        "History of Tech", "Self-Help Handbook", "Fantasy Epic", "Business Strategy", "Travel Diary",
        "Poetry Collection", "Startup Playbook", "AI Handbook", "Finance Basics",
        "Biography Collection", "Thriller Series", "Design Principles", "Health & Fitness",
        "Short Stories",
    ],
    "auto": [
        "Car Phone Mount", "Dash Cam", "Tire Inflator", "Seat Cover", "LED Headlights", "Oil Filter",
        "Car Vacuum", "Jump Starter", "Floor Mats", "Steering Cover", "Air Freshener Pack", "Tool Kit",
        "Wiper Blades", "Car Charger", "Trunk Organizer", "Tire Gauge", "Cleaning Kit", "Sun Shade",
    ],
}


# --- dimensions -------------------------------------------------------------------
def dim_date(silver_orders: DataFrame) -> DataFrame:
    """One row per purchase date; the calendar parts are derived after the distinct."""
    days = (
        silver_orders.select(F.to_date("order_purchase_timestamp").alias("date_key"))
        .filter(F.col("date_key").isNotNull())
        .distinct()
    )
    return days.select("date_key", *[c.alias(n) for n, c in calendar_parts(F.col("date_key")).items()])


def dim_customers(silver_customers: DataFrame, last_key: int = 0) -> DataFrame:
    """New customer rows with surrogate keys that continue after ``last_key``."""
    rows = silver_customers.select(
        "customer_id", "customer_unique_id", "customer_city", "customer_state", "customer_zip_code_prefix"
    )
    return number_rows(rows, ["customer_id"], "customer_sk", after=last_key)


def product_rows(silver_products: DataFrame) -> DataFrame:
    return silver_products.select(
        "product_id", "product_category_name", "product_weight_g", "product_name", "product_brand"
    )


def dim_products(silver_products: DataFrame, last_key: int = 0) -> DataFrame:
    """New product rows with surrogate keys; names are assigned over the whole dimension."""
    return number_rows(product_rows(silver_products), ["product_id"], "product_sk", after=last_key)


def _name_pool(category: Column) -> Column:
    """The name list of a category as one CASE over seven literals; NULL outside the pools."""
    branches = [
        (category == name, F.array(*[F.lit(n) for n in names])) for name, names in PRODUCT_NAMES.items()
    ]
    return reduce(lambda case, b: case.when(*b), branches[1:], F.when(*branches[0]))


def name_products(dimension: DataFrame) -> DataFrame:
    """Readable names ``<pool name> #<rank>`` for products of the known categories.

    The rank is the product's position by id inside its category.  Products of other
    categories (or none) keep their name and are not ranked at all.  Ranked and
    unranked rows are unioned, so writing the names back needs no join.
    """
    known = F.coalesce(F.col("product_category_name").isin(*PRODUCT_NAMES), F.lit(False))
    ranked = number_rows(
        dimension.filter(known), ["product_id"], "_rank", group_by=["product_category_name"]
    )
    pool = _name_pool(F.col("product_category_name"))
    rank = F.col("_rank").cast("string")
    pick = F.element_at(pool, (F.lit(1) + F.pmod(F.col("_rank") - 1, F.size(pool))).cast("int"))
    label = F.concat(pick, F.lit(" #"), F.lpad(rank, F.greatest(F.lit(3), F.length(rank)), F.lit("0")))
    named = ranked.withColumn("product_name", label).drop("_rank")
    return named.unionByName(dimension.filter(~known))


# --- facts ------------------------------------------------------------------------
def fact_order_items(silver_items: DataFrame, silver_orders: DataFrame) -> DataFrame:
    """Items with their order's purchase date; items without an order drop out.

    ``silver_orders`` should be a stored table: its size then decides for a broadcast
    or a shuffle, and AQE's skew join can split an order with very many items (it does
    so only when each side is shuffled for the join itself, not for an aggregate).
    """
    purchase = silver_orders.select(
        "order_id", F.to_date("order_purchase_timestamp").alias("order_purchase_date")
    )
    return silver_items.join(purchase, "order_id").select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "order_purchase_date",
        "price",
        "freight_value",
        "discount_rate",
        "line_total",
    )


def fact_orders(silver_orders: DataFrame, silver_items: DataFrame, silver_returns: DataFrame) -> DataFrame:
    """Order grain with item totals and return totals.

    Items and returns are aggregated to the order id first; both joins then use the
    partitioning of those aggregates.
    """
    items = silver_items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum("price").alias("gross"),
        F.sum("freight_value").alias("freight"),
        F.sum("line_total").alias("net"),
    )
    returned = silver_returns.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("returns"), F.sum("refund_amount").alias("refund")
    )

    def total(name: str, target: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast(target)

    joined = silver_orders.join(items, "order_id", "left").join(returned, "order_id", "left")
    return joined.select(
        "order_id",
        "customer_id",
        F.to_date("order_purchase_timestamp").alias("order_purchase_date"),
        "order_status",
        "latest_logistics_status",
        "carrier",
        "warehouse_id",
        "is_delivered",
        "is_cancelled",
        "is_delayed",
        "delivery_delay_days",
        total("item_count", "int").alias("order_item_count"),
        total("gross", MONEY).alias("order_gross_value"),
        total("freight", MONEY).alias("order_freight_value"),
        total("net", MONEY).alias("order_net_value"),
        F.col("returns").isNotNull().alias("has_return"),
        total("returns", "int").alias("return_count"),
        total("refund", MONEY).alias("total_refund_amount"),
    )


def fact_returns(silver_returns: DataFrame) -> DataFrame:
    return silver_returns.select(
        "return_id",
        "order_id",
        "product_id",
        "return_date",
        "return_reason",
        "return_status",
        "quantity",
        "refund_amount",
        "refund_currency",
    )


# --- KPI tables -------------------------------------------------------------------
def daily_sales_summary(orders: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return (
        orders.filter(F.col("order_purchase_date").isNotNull())
        .groupBy(F.col("order_purchase_date").alias("sales_date"))
        .agg(
            n.cast("bigint").alias("total_orders"),
            F.count_if("is_delivered").cast("bigint").alias("delivered_orders"),
            F.count_if("is_cancelled").cast("bigint").alias("cancelled_orders"),
            F.count_if("is_delayed").cast("bigint").alias("delayed_orders"),
            sum_or_zero(F.col("order_item_count"), "bigint").alias("total_items"),
            sum_or_zero(F.col("order_gross_value"), KPI_MONEY).alias("gross_revenue"),
            sum_or_zero(F.col("order_net_value"), KPI_MONEY).alias("net_revenue"),
            sum_or_zero(F.col("order_freight_value"), KPI_MONEY).alias("total_freight"),
            ratio(F.sum("order_net_value"), n, 2, "decimal(12,2)").alias("avg_order_value"),
            sum_or_zero(F.col("return_count"), "bigint").alias("total_returns"),
            sum_or_zero(F.col("total_refund_amount"), KPI_MONEY).alias("total_refund_amount"),
            ratio(F.sum("return_count"), n, 4, RATE).alias("return_rate"),
        )
    )


def product_performance(products: DataFrame, order_items: DataFrame, returned: DataFrame) -> DataFrame:
    """Per product of the dimension: orders, revenue, returns; zero where nothing happened."""
    sold = order_items.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("sold"), F.sum("price").alias("gross"), F.sum("line_total").alias("net")
    )
    sent_back = returned.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("back"), F.sum("refund_amount").alias("refund")
    )

    def total(name: str, target: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast(target)

    rate = F.coalesce(
        ratio(total("back", "bigint"), F.col("sold"), 4, RATE), F.lit(0).cast(RATE)
    )
    joined = (
        products.select("product_id", "product_category_name")
        .join(sold, "product_id", "left")
        .join(sent_back, "product_id", "left")
    )
    return joined.select(
        "product_id",
        "product_category_name",
        total("sold", "bigint").alias("times_ordered"),
        total("sold", "bigint").alias("total_quantity_proxy"),
        total("gross", KPI_MONEY).alias("gross_revenue"),
        total("net", KPI_MONEY).alias("net_revenue"),
        total("back", "bigint").alias("times_returned"),
        total("refund", KPI_MONEY).alias("total_refund_amount"),
        rate.alias("return_rate"),
    )


def return_rate_by_reason(returned: DataFrame) -> DataFrame:
    counts = (
        returned.filter(F.col("return_reason").isNotNull())
        .groupBy("return_reason")
        .agg(
            F.count(F.lit(1)).alias("return_count"),
            sum_or_zero(F.col("refund_amount"), KPI_MONEY).alias("total_refund_amount"),
        )
    )
    # Stored, so the total reads these few rows instead of running everything below again.
    counts = pin(counts, "reasons")
    share = share_of_total(counts, "return_count", 4, RATE)
    return counts.select(
        "return_reason",
        F.col("return_count").cast("bigint").alias("return_count"),
        "total_refund_amount",
        share.alias("pct_of_all_returns"),
    )


def delivery_performance(orders: DataFrame, as_of: date) -> DataFrame:
    """One snapshot row; ``as_of`` is the snapshot date of the run."""
    n = F.count(F.lit(1))
    delay = F.when(F.col("is_delayed"), F.col("delivery_delay_days"))
    return orders.agg(
        F.lit(as_of).cast("date").alias("snapshot_date"),
        n.cast("bigint").alias("total_orders"),
        F.count_if("is_delivered").cast("bigint").alias("delivered_orders"),
        F.count_if("is_cancelled").cast("bigint").alias("cancelled_orders"),
        F.count_if("is_delayed").cast("bigint").alias("delayed_orders"),
        ratio(F.count_if("is_delivered"), n, 4, RATE).alias("delivery_rate"),
        ratio(F.count_if("is_cancelled"), n, 4, RATE).alias("cancellation_rate"),
        ratio(F.count_if("is_delayed"), n, 4, RATE).alias("delay_rate"),
        ratio(F.sum(delay), F.count(delay), 2, "decimal(8,2)").alias("avg_delay_days"),
    )
