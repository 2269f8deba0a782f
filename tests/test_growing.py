from __future__ import annotations

import os
from dataclasses import replace
from datetime import date, datetime

import pytest
from conftest import rows

from silverlode.plans import gold, incremental
from silverlode.schemas import TABLES, TableSpec
from silverlode.sinks import TableStore
from silverlode.sinks.growing import Fragment, GrowingTable, key_mask

SCHEMA = "k BIGINT, v STRING"


@pytest.fixture
def table(spark, tmp_path):
    from pyspark.sql.types import StructType

    return GrowingTable(spark, str(tmp_path / "t"), StructType.fromDDL(SCHEMA), ["k"], bucket_rows=40)


def batch(spark, keys, value):
    return spark.createDataFrame([(k, value) for k in keys], SCHEMA)


def folders(table):
    return {f"{f.load}/{f.name}" for f in table.directory() if f.load}


def covered(directory: list[Fragment]) -> bool:
    """Every hash falls into exactly one bucket."""
    buckets = {f.bucket for f in directory}
    deepest = max(d for d, _ in buckets)
    slots = [s for d, b in buckets for s in range(b, 1 << deepest, 1 << d)]
    return sorted(slots) == list(range(1 << deepest))


def test_buckets_stay_small_over_ten_upserts(spark, table):
    expected = {}
    for number in range(10):
        keys = range(number * 25, number * 25 + 60)
        added = len(set(keys) - set(expected))
        expected |= {k: f"b{number}" for k in keys}
        assert table.upsert(batch(spark, keys, f"b{number}")) == added
        directory = table.directory()
        assert max(f.rows for f in directory) <= 40 and covered(directory)
    assert dict(rows(table.read())) == expected and table.rows_stored() == len(expected)
    assert len({f.bucket for f in directory}) >= 8


def test_an_upsert_leaves_the_files_of_other_buckets_alone(spark, table):
    table.upsert(batch(spark, range(400), "old"))
    before, files = folders(table), set(table.read().inputFiles())
    table.upsert(batch(spark, [7, 8], "new"))
    assert len(before - folders(table)) <= 2 < len(before & folders(table))
    kept = files & set(table.read().inputFiles())
    assert len(kept) >= len(files) - 4 and all(os.path.exists(f.removeprefix("file://").removeprefix("file:")) for f in kept)
    got = dict(rows(table.read()))
    assert (got[7], got[8], got[9], len(got)) == ("new", "new", "old", 400)


def test_inserts_read_only_fragments_that_may_know_a_key(spark, table):
    table.upsert(batch(spark, range(2000), "old"))
    stored = [f for f in table.directory() if f.load]
    unknown, known = batch(spark, range(10_000, 10_010), "new"), batch(spark, [5, 10_003], "new")
    assert len(table.known_fragments(unknown)) < len(stored) / 10
    assert 1 <= len(table.known_fragments(known)) < len(stored) / 10
    assert rows(table.absent(known)) == [(10_003, "new")]
    assert len(table.known_fragments(batch(spark, range(2000), "x"))) == len(stored)
    assert table.absent(batch(spark, range(1990, 2010), "x")).count() == 10


def test_inserts_add_fragments_until_a_bucket_is_crowded(spark, table):
    table.most_fragments = 3
    for number in range(6):
        fresh = table.absent(batch(spark, range(number * 4, number * 4 + 8), f"b{number}"))
        table.insert(fresh)
    got = dict(rows(table.read()))
    assert got == {k: f"b{max(k // 4 - 1, 0)}" for k in range(28)}
    per_bucket = {}
    for f in table.directory():
        per_bucket[f.bucket] = per_bucket.get(f.bucket, 0) + (f.load is not None)
    assert max(per_bucket.values()) <= 3


def test_a_load_that_dies_before_its_rename_changes_nothing(spark, table, monkeypatch):
    table.upsert(batch(spark, range(100), "old"))

    def die(self, directory):
        raise KeyboardInterrupt("executor, driver and all")

    with monkeypatch.context() as m:
        m.setattr(GrowingTable, "_publish", die)
        for change in (table.upsert, table.replace, table.insert):
            with pytest.raises(KeyboardInterrupt):
                change(batch(spark, range(50, 150), "new"))
            assert dict(rows(table.read())) == {k: "old" for k in range(100)} and table.version() == 1
    table.upsert(batch(spark, range(50, 150), "new"))
    assert dict(rows(table.read())) == {k: "old" if k < 50 else "new" for k in range(150)}
    assert table.clean_up(keep=1) > 3
    assert dict(rows(table.read())) == {k: "old" if k < 50 else "new" for k in range(150)}


def test_readers_of_the_last_version_keep_their_files(spark, table):
    table.upsert(batch(spark, range(60), "one"))
    reader = table.read()
    table.replace(reader.where("k < 5"))
    assert table.clean_up() == 0
    assert reader.count() == 60 and rows(table.read(), "k") == [(k,) for k in range(5)]


def test_odd_keys_and_empty_batches(spark, tmp_path):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("a STRING, b INT, `bits.x` STRING, load STRING")
    table = GrowingTable(spark, str(tmp_path / "odd"), schema, ["a", "b"], bucket_rows=2)
    empty = spark.createDataFrame([], schema)
    assert (table.upsert(empty), table.insert(empty), table.version()) == (0, 0, 0) and table.read().isEmpty()
    data = [("é", 1, "x", None), ("", 2, None, "y"), ("long" * 5000, 3, "x", "y"), *[("k", i, "b", "l") for i in range(12)]]
    table.upsert(spark.createDataFrame(data, schema))
    assert rows(table.read()) == sorted(data, key=repr)
    assert table.absent(spark.createDataFrame([("é", 1, "n", "n"), ("é", 2, "n", "n")], schema)).count() == 1


def test_reserved_names_are_refused(spark, tmp_path):
    from pyspark.sql.types import StructType

    with pytest.raises(ValueError, match="_bits"):
        GrowingTable(spark, str(tmp_path), StructType.fromDDL("k INT, _bits INT"), ["k"])


def test_masks_set_at_most_five_bits_of_a_word(spark):
    counts = spark.range(500).selectExpr(f"bit_count({key_mask('xxhash64(id)')}) AS n").agg({"n": "max"}).first()[0]
    assert 4 <= counts <= 5


# --- through the table store ------------------------------------------------------------
@pytest.fixture
def store(spark, tmp_path):
    spec = TableSpec("x.grown", "k BIGINT, v STRING", ("k",), defaults={"v": "none"}).growing(30)
    return TableStore(spark, str(tmp_path / "store"), {"x.grown": spec})


def test_store_policies_on_a_growing_table(spark, store):
    store.bootstrap()
    assert store.read("x.grown").count() == 0
    first = store.insert_if_absent("x.grown", spark.createDataFrame([(1, "a"), (1, "b"), (None, "z"), (2, None)], SCHEMA))
    assert (first.rows_attempted, first.rows_rejected, first.rows_before, first.rows_inserted) == (4, 1, 0, 2)
    again = store.insert_if_absent("x.grown", spark.createDataFrame([(1, "new"), (3, "d")], SCHEMA))
    assert (again.rows_before, again.rows_inserted, again.rows_after) == (2, 1, 3)
    assert rows(store.rows("x.grown")) == [(1, "a"), (2, "none"), (3, "d")]
    report = store.upsert("x.grown", spark.createDataFrame([(3, "x"), (3, "y"), (None, "q"), (4, "e")], SCHEMA), order_by=["v"])
    assert (report.rows_rejected, report.rows_before, report.rows_inserted, report.rows_after) == (1, 3, 1, 4)
    assert dict(rows(store.rows("x.grown"))) == {1: "a", 2: "none", 3: "y", 4: "e"}
    assert spark.read.parquet(store.path("x.grown") + "_rejects").count() == 2
    store.append("x.grown", spark.range(100, 200).selectExpr("id AS k", "'bulk' AS v"))
    assert store.count("x.grown") == 104 == store.read("x.grown").count()
    store.replace("x.grown", store.rows("x.grown").filter("k < 3"), reads_itself=True)
    assert rows(store.rows("x.grown")) == [(1, "a"), (2, "none")]


# --- incremental KPI tables ---------------------------------------------------------------
ORDERS = (
    "order_id STRING, order_purchase_date DATE, is_delivered BOOLEAN, is_cancelled BOOLEAN, is_delayed BOOLEAN, "
    "delivery_delay_days INT, order_item_count INT, order_gross_value DECIMAL(14,2), order_freight_value DECIMAL(14,2), "
    "order_net_value DECIMAL(14,2), return_count INT, total_refund_amount DECIMAL(14,2)"
)
AS_OF = date(2024, 5, 1)


def order_facts(spark, start, stop, factor=1):
    return spark.range(start, stop).selectExpr(
        "concat('o', id) AS order_id", "if(id % 11 = 0, NULL, date_add(DATE'2024-01-01', int(id % 9))) AS order_purchase_date",
        "id % 3 = 0 AS is_delivered", "id % 3 = 1 AS is_cancelled", "if(id % 7 = 0, NULL, id % 5 = 0) AS is_delayed",
        "int(id % 6) AS delivery_delay_days", "int(id % 4) AS order_item_count", f"CAST(id * {factor} AS DECIMAL(14,2)) AS order_gross_value",
        "CAST(id % 3 AS DECIMAL(14,2)) AS order_freight_value", f"CAST(id * {factor} - 0.5 AS DECIMAL(14,2)) AS order_net_value",
        "int(id % 2) AS return_count", "CAST(id % 2 * 3.25 AS DECIMAL(14,2)) AS total_refund_amount",
    )


@pytest.fixture
def sums(spark, tmp_path):
    """KPI sums in buckets of a few rows."""
    return TableStore(spark, str(tmp_path / "sums"), {**TABLES, incremental.DAILY: replace(TABLES[incremental.DAILY], bucket_rows=3)})


def test_daily_and_delivery_sums_follow_inserts_reruns_and_replacements(spark, sums):
    loads = [order_facts(spark, 0, 30), order_facts(spark, 30, 70), order_facts(spark, 70, 75)]
    for day, facts in enumerate(loads, 1):
        for _ in range(2):  # the second run of a load adds nothing
            incremental.apply_orders(sums, facts, datetime(2024, 4, day))
    everything = order_facts(spark, 0, 75)
    assert rows(incremental.daily_sales_summary(sums)) == rows(gold.daily_sales_summary(everything))
    assert rows(incremental.delivery_performance(sums, AS_OF)) == rows(gold.delivery_performance(everything, AS_OF))

    before = folders(sums.growing(incremental.DAILY))
    one_day = "order_purchase_date = DATE'2024-01-03'"
    incremental.apply_orders(
        sums, order_facts(spark, 0, 75, 2).where(one_day), datetime(2024, 4, 9), replaced=everything.where(one_day)
    )
    assert len(before & folders(sums.growing(incremental.DAILY))) == len(before) - 1
    changed = order_facts(spark, 0, 75, 2).where(one_day).unionByName(everything.where(f"NOT coalesce({one_day}, FALSE)"))
    assert rows(incremental.daily_sales_summary(sums)) == rows(gold.daily_sales_summary(changed))
    # A day whose orders all leave is no row.
    incremental.apply_orders(sums, everything.limit(0), datetime(2024, 4, 10), replaced=changed.where(one_day))
    assert incremental.daily_sales_summary(sums).where("sales_date = DATE'2024-01-03'").isEmpty()


def test_kpis_before_the_first_load(spark, sums):
    assert incremental.daily_sales_summary(sums).isEmpty() and incremental.return_rate_by_reason(sums).isEmpty()
    assert rows(incremental.delivery_performance(sums, AS_OF)) == rows(gold.delivery_performance(order_facts(spark, 0, 0), AS_OF))
    products = spark.createDataFrame([("p", "toys")], "product_id STRING, product_category_name STRING")
    assert [tuple(r)[2:4] for r in incremental.product_performance(sums, products).collect()] == [(0, 0)]


def test_product_and_reason_sums_equal_the_full_tables(spark, sums):
    items = spark.range(90).selectExpr(
        "concat('o', id) AS order_id", "if(id % 10 = 0, NULL, concat('p', id % 6)) AS product_id",
        "CAST(id AS DECIMAL(12,2)) AS price", "CAST(id * 0.9 AS DECIMAL(12,2)) AS line_total")
    returned = spark.range(40).selectExpr(
        "concat('o', id) AS order_id", "concat('p', id % 8) AS product_id", "if(id % 5 = 0, NULL, concat('r', id % 3)) AS return_reason",
        "CAST(id AS DECIMAL(12,2)) AS refund_amount")
    products = spark.range(9).selectExpr("concat('p', id) AS product_id", "'toys' AS product_category_name")
    for n in range(3):
        part = f"abs(hash(order_id)) % 3 = {n}"
        incremental.apply_sales(sums, items.where(part), returned.where(part), datetime(2024, 4, n + 1))
    assert rows(incremental.product_performance(sums, products)) == rows(gold.product_performance(products, items, returned))
    assert rows(incremental.return_rate_by_reason(sums)) == rows(gold.return_rate_by_reason(returned))


def test_gold_built_by_increments_equals_gold_built_from_all_facts(spark, tmp_path):
    from silverlode.plans import jobs

    store = TableStore(spark, str(tmp_path / "platform"))

    def deliver(start, stop):
        ids = spark.range(start, stop).selectExpr("id", "concat('o', id) AS order_id", "concat('c', id) AS customer_id", "concat('p', id) AS product_id")
        store.append("silver.customers", ids)
        store.append("silver.products", ids.selectExpr("product_id", "if(id % 2 = 0, 'toys', 'books') AS product_category_name"))
        store.append("silver.orders", ids.selectExpr(
            "order_id", "customer_id", "timestamp_ntz'2024-01-01 08:00:00' + make_dt_interval(int(id % 5)) AS order_purchase_timestamp",
            "id % 2 = 0 AS is_delivered", "id % 3 = 0 AS is_cancelled", "id % 4 = 0 AS is_delayed", "int(id % 4) AS delivery_delay_days"))
        store.append("silver.order_items", ids.selectExpr(
            "order_id", "1 AS order_item_id", "concat('p', id % 7) AS product_id", "id + 0.5 AS price", "1.25 AS freight_value", "id + 0.25 AS line_total"))
        store.append("silver.returns", ids.where("id % 3 = 1").selectExpr(
            "concat('r', id) AS return_id", "order_id", "concat('p', id % 7) AS product_id", "if(id % 2 = 0, 'late', 'broken') AS return_reason", "id * 0.1 AS refund_amount"))

    for day, (start, stop) in enumerate([(0, 12), (12, 20)], 1):
        deliver(start, stop)
        jobs.build_gold(store, AS_OF, datetime(2024, 4, day), incremental_kpis=True)
    facts, items, returned = (store.rows(f"gold.fact_{t}") for t in ("orders", "order_items", "returns"))
    assert facts.count() == 20
    for table, full in (
        ("gold.daily_sales_summary", gold.daily_sales_summary(facts)),
        ("gold.product_performance", gold.product_performance(store.rows("gold.dim_products"), items, returned)),
        ("gold.return_rate_by_reason", gold.return_rate_by_reason(returned)),
        ("gold.delivery_performance", gold.delivery_performance(facts, AS_OF)),
    ):
        assert rows(store.rows(table).drop("_loaded_at")) == rows(full), table
    before = rows(incremental.daily_sales_summary(store))
    incremental.rebuild(store, datetime(2024, 4, 9))
    assert rows(incremental.daily_sales_summary(store)) == before
    with pytest.raises(ValueError):
        jobs.build_gold(store, AS_OF, datetime(2024, 4, 3), policy="upsert", incremental_kpis=True)


def _stored_copies(monkeypatch):
    """Label and columns of every copy that growing tables store aside."""
    from silverlode.sinks import growing

    found, pin = [], growing.pin

    def noted(df, label):
        found.append((label, df.columns))
        return pin(df, label)

    monkeypatch.setattr(growing, "pin", noted)
    return found


def test_copies_of_a_load_hold_no_hashes(spark, table, monkeypatch):
    copies = _stored_copies(monkeypatch)
    table.upsert(batch(spark, range(100), "a"))
    table.upsert(batch(spark, range(50, 150), "b"))
    assert {label for label, _ in copies} == {"fresh", "merged"}
    assert all(columns == ["k", "v"] for _, columns in copies)
    assert rows(table.read()) == rows(batch(spark, range(50), "a").union(batch(spark, range(50, 150), "b")))
    assert not table.absent(batch(spark, range(150), "c")).count()


def test_filters_are_built_from_the_written_files_without_a_range_shuffle(spark, table):
    table.insert(batch(spark, range(200), "a"))
    stored = [f for f in table.directory() if f.load]
    plan = table._filters(stored[0].load, stored)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "_bucket" in plan
    assert plan.count("hashpartitioning") == 1


def test_offered_rows_are_computed_once(spark, table, monkeypatch):
    table.insert(batch(spark, range(100), "a"))
    copies = _stored_copies(monkeypatch)
    assert rows(table.absent(batch(spark, range(90, 110), "b"))) == [(k, "b") for k in range(100, 110)]
    assert ("offered", ["k", "v"]) in copies


def test_sales_batches_store_only_what_their_sums_need(spark, monkeypatch):
    from workload import queries

    copies, pin = {}, queries.pin
    monkeypatch.setattr(queries, "pin", lambda df, label: copies.setdefault(label, pin(df, label)))
    model = queries.Model(spark, "/root/testdata/sf0.001")
    got = queries.product_performance_incremental(model)
    assert copies["items"].columns == ["order_id", "product_id", "price", "line_total"]
    assert copies["returned"].columns == ["order_id", "product_id", "return_reason", "refund_amount"]
    assert rows(got) == rows(model.product_performance().select(*got.columns))
