"""Plan shape at scale: pushed filters, pruned columns, map-side combine, skew handling, no Python."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from silverlode.operators import check_references, first_per_key, latest_per_key, number_rows, pin
from silverlode.plans import gold
from silverlode.plans.checks import BRONZE_REFERENCES
from workload.queries import QUERIES, Model

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plan as for inputs far beyond the broadcast threshold."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def model(spark):
    return Model(spark, FOLDER)


def scanned(text, table):
    """Columns each scan of ``table`` reads."""
    return [
        set(re.findall(r"(\w+):", schema))
        for location, schema in re.findall(r"Location: \S+ ?\S*\[([^\]]*)\][^\n]*ReadSchema: struct<([^>]*)>", text)
        if table in location
    ]


def test_no_query_uses_python_workers(model):
    for name in ("daily_sales_summary", "product_performance", "taxi_clean", "dq_bronze", "dim_date", "fx_flatten"):
        text = plan(QUERIES[name](model))
        assert "Python" not in text and "ArrowEval" not in text, name


def test_dim_date_reads_only_what_it_needs(model):
    """The partner statuses and all order columns but key and date drop out of the plan."""
    text = plan(model.dim_date())
    assert "events.parquet" not in text


def test_trip_filters_reach_the_scan(model):
    text = plan(model.taxi_stage())
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(ts\)", text)


def test_order_facts_shuffle_each_input_to_the_order_id_once(model, no_broadcast):
    """Aggregates feed both joins with their own partitioning: one exchange on order_id per input."""
    text = plan(model.fact_orders())
    by_order = re.findall(r"Exchange hashpartitioning\(order_id#\d+, \d+\)", text)
    assert len(by_order) == 4  # orders, statuses, items, returns
    assert text.count("SortMergeJoin") == 3


@pytest.mark.parametrize("operator", [first_per_key, latest_per_key])
def test_key_winners_are_combined_before_the_shuffle(spark, operator):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").cast("string").alias("v"))
    got = operator(df, ["k"]) if operator is first_per_key else operator(df, ["k"], ["v"])
    below_exchange = plan(got).split("Exchange")[1]
    assert "partial_" in below_exchange


def test_orphan_checks_of_one_parent_share_one_join(model, no_broadcast):
    text = plan(check_references(model.landed(), BRONZE_REFERENCES))
    assert text.count("SortMergeJoin") == 1
    assert scanned(text, "orders.parquet") == [{"o_orderkey"}]


def test_no_cross_joins(model, no_broadcast):
    for name in ("fact_orders", "product_performance", "return_rate_by_reason", "dim_products_named", "dq_bronze"):
        text = plan(QUERIES[name](model))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_one_order_with_most_items_is_split_by_the_skew_join(spark, no_broadcast):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.files.maxPartitionBytes": "16k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        order = F.when(F.col("id") < n // 3, F.lit("hot")).otherwise(F.concat(F.lit("o"), F.col("id")))
        items = spark.range(0, n, 1, 16).select(
            order.alias("order_id"),
            F.col("id").cast("int").alias("order_item_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("product_id"),
            F.lit("s").alias("seller_id"),
            *[F.lit(1).cast("decimal(12,2)").alias(c) for c in ("price", "freight_value", "line_total")],
            F.lit(0).cast("decimal(5,4)").alias("discount_rate"),
        )
        orders = items.select("order_id").distinct().withColumn(
            "order_purchase_timestamp", F.lit("2024-01-01").cast("timestamp_ntz")
        )
        facts = gold.fact_order_items(pin(items, "items"), pin(orders, "orders"))
        executed = facts.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
        assert sum(r.n for r in executed.collect()) == n
        assert "SortMergeJoin(skew=true)" in plan(executed)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_numbering_joins_its_offsets_without_shuffling_the_rows(spark):
    rows = spark.range(1000).select((F.col("id") % 3).cast("string").alias("g"), F.col("id").alias("k"))
    text = plan(number_rows(rows, ["k"], "n", group_by=["g"]))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert "Window" not in text


def test_quiet_csv_blocks_are_parsed_where_they_are_read(spark, tmp_path):
    """A file without line breaks in cells costs no shuffle of its text, however many blocks it has."""
    from pyspark.sql import types as T

    from silverlode.sources import csv_blocks

    path = tmp_path / "quiet.csv"
    path.write_text("id,note\n" + "".join(f'{i},"x, {i}"\n' for i in range(2000)))
    keys = {"spark.sql.files.maxPartitionBytes": "4000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        got = csv_blocks.read_named(spark, str(path), T.StructType.fromDDL("id INT, note STRING"))
        text = plan(got)
        assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text
        assert got.rdd.getNumPartitions() > 4 and got.count() == 2000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
