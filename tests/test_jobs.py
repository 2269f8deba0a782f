"""The pipelines end to end against a temporary store."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from silverlode.plans import dashboard, jobs
from silverlode.schemas import PARTNER_FEEDS
from silverlode.sinks import TableStore
from silverlode.streaming.feeds import stream_feed

NOW = datetime(2024, 3, 1, 12)
TODAY = date(2024, 3, 1)

SHOP = {
    "orders.csv": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1, Delivered ,2024-01-01 10:00:00,,,2024-01-09 01:00:00,2024-01-08 23:00:00
o2,c1,Canceled,2024-01-01 11:00:00,,,,2024-01-08 00:00:00
o3,c2,shipped,2024-01-02 09:00:00,,,2024-01-05 00:00:00,2024-01-08 00:00:00
o4,c9,shipped,,,,,
""",
    "order_items.csv": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value,discount_rate
o1,1,p1,s1,2024-01-03 00:00:00,10.00,1.50,0.1
o1,2,p2,s1,2024-01-03 00:00:00,5.05,0.50,
o3,1,p1,s2,2024-01-04 00:00:00,20.00,2.00,0
o3,1,p1,s2,2024-01-04 00:00:00,99.00,2.00,0
zz,1,p3,s2,2024-01-04 00:00:00,7.00,2.00,0
""",
    "customers.csv": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,01234, new york ,ny
c2,u2,00001,o'fallon,mo
""",
    "products.csv": """product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm
p1, Toys ,5.0,10,1,100,1,1,1
p2,toys,6,10,1,50,1,1,1
p3,,6,10,1,50,1,1,1
""",
}
STATUS = """order_id,status,status_timestamp,carrier,tracking_number,warehouse_id,notes,source_system,file_date
o1,shipped,2024-01-02 00:00:00, UPS ,T1,WH-01,,hub,2024-01-02
o3,shipped,2024-01-03 00:00:00,UPS,T3,WH-02,,hub,2024-01-03
o3,delivered,2024-01-04 00:00:00,,,WH-02,,hub,2024-01-04
"""
RETURNS = """return_id,order_id,product_id,return_date,return_reason,refund_amount,refund_currency,return_status,quantity,source_system,file_date
r1,o1,p1,2024-01-20, Defective ,9.00,usd,Approved,1,desk,2024-01-20
r2,o1,p2,2024-01-21,defective,4.00,usd,Approved,1,desk,2024-01-21
r3,xx,p9,2024-01-22,,1.00,usd,Approved,1,desk,2024-01-22
"""
INVENTORY = """product_id,warehouse_id,snapshot_date,quantity_on_hand,quantity_reserved,quantity_available,reorder_point,category,is_stockout,source_system,file_date
p1,WH-01,2024-01-15,10,10,0,5, Toys ,True,wh,2024-01-15
"""


def write(folder, files):
    for name, text in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    return str(folder)


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def load_all(store, tmp_path):
    shop = write(tmp_path / "shop", SHOP)
    feeds = write(
        tmp_path / "feeds",
        {"order_status/s1.csv": STATUS, "returns/r1.csv": RETURNS, "inventory/i1.csv": INVENTORY},
    )
    fx = write(tmp_path / "fx", {"2024-01-05.json": '{"date": "2024-01-05", "rates": {"EUR": 0.9}}'})
    loaded = jobs.load_shop_files(store, shop, "b1", NOW)
    fed = jobs.load_feeds(store, feeds, "run-1", NOW)
    report, missing = jobs.load_rates(store, fx, date(2024, 1, 4), date(2024, 1, 5), "fx1", NOW)
    return loaded, fed, report, missing, feeds


def test_platform_run_and_rerun(spark, store, tmp_path):
    loaded, fed, report, missing, feeds = load_all(store, tmp_path)
    assert rows(loaded, "table_name", "status", "rows_read", "rows_inserted") == [
        ("bronze.customers", "success", 2, 2),
        ("bronze.order_items", "success", 5, 4),
        ("bronze.orders", "success", 4, 4),
        ("bronze.products", "success", 3, 3),
    ]
    assert {r.status for r in fed.collect()} == {"success"}
    assert report.rows_inserted == 1 and rows(missing) == [(date(2024, 1, 4),)]
    log = store.rows("logs.file_ingestion_log")
    assert rows(log, "file_name", "status", "rows_loaded", "rows_inserted") == [
        ("i1.csv", "processed", 1, 1),
        ("r1.csv", "processed", 3, 3),
        ("s1.csv", "processed", 3, 3),
    ]

    # One critical rule fails (an order without purchase time); results are stored first.
    with pytest.raises(ValueError, match="bronze.orders.null_purchase_timestamp=1"):
        jobs.check_bronze(store, "dq-1", NOW)
    results = store.rows("logs.data_quality_results")
    assert results.count() == 19
    assert '"failed_rows":1' in results.filter("status = 'failed'").first().details
    summary = jobs.check_bronze(store, "dq-2", NOW, fail_on_critical=False)
    assert tuple(summary.first()) == (19, 1, 2)
    # The same run again replaces its own results.
    jobs.check_bronze(store, "dq-2", NOW, fail_on_critical=False)
    assert store.rows("logs.data_quality_results").count() == 38

    jobs.build_silver(store, "s1", NOW)
    assert rows(store.rows("silver.customers"), "customer_city", "customer_state", "customer_zip_code_prefix") == [
        ("O'Fallon", "MO", "00001"),
        ("New York", "NY", "01234"),
    ]
    assert rows(
        store.rows("silver.orders"),
        "order_id", "latest_logistics_status", "carrier", "is_delivered", "is_cancelled", "is_delayed",
        "delivery_delay_days",
    ) == [
        ("o1", "shipped", "UPS", True, False, True, 1),
        ("o2", None, None, False, True, False, None),
        ("o3", "delivered", None, True, False, False, -3),
        ("o4", None, None, False, False, False, None),
    ]

    jobs.build_gold(store, TODAY, NOW)
    assert rows(store.rows("gold.dim_products"), "product_sk", "product_id", "product_name") == [
        (1, "p1", "Building Blocks #001"),
        (2, "p2", "Remote Car #002"),
        (3, "p3", None),
    ]
    assert rows(
        store.rows("gold.fact_orders"),
        "order_id", "order_item_count", "order_net_value", "has_return", "return_count", "total_refund_amount",
    ) == [
        ("o1", 2, Decimal("14.05"), True, 2, Decimal("13.00")),
        ("o2", 0, Decimal("0.00"), False, 0, Decimal("0.00")),
        ("o3", 1, Decimal("20.00"), False, 0, Decimal("0.00")),
        ("o4", 0, Decimal("0.00"), False, 0, Decimal("0.00")),
    ]
    daily = store.rows("gold.daily_sales_summary")
    assert rows(daily, "sales_date", "total_orders", "avg_order_value", "return_rate") == [
        (date(2024, 1, 1), 2, Decimal("7.03"), Decimal("1.0000")),
        (date(2024, 1, 2), 1, Decimal("20.00"), Decimal("0.0000")),
    ]
    assert rows(store.rows("gold.return_rate_by_reason"), "return_reason", "pct_of_all_returns") == [
        ("defective", Decimal("1.0000"))
    ]
    assert jobs.check_ready(store).count() == 4
    kpis = dashboard.period_kpis(daily, date(2024, 1, 1), date(2024, 1, 1)).first()
    assert (kpis.total_orders, kpis.delivery_rate, kpis.return_rate) == (2, 0.5, 1.0)

    # Unchanged files are skipped.
    again = jobs.load_feeds(store, feeds, "run-2", NOW)
    assert {r.reason for r in again.collect()} == {"already_processed"}

    # A changed feed file is loaded again, but stored orders keep their first status:
    # the second silver and gold runs insert nothing ...
    later = STATUS + "o1,cancelled,2024-02-01 00:00:00,,,WH-01,,hub,2024-02-01\n"
    write(tmp_path / "feeds", {"order_status/s1.csv": later})
    changed = jobs.load_feeds(store, feeds, "run-3", NOW)
    assert rows(changed.filter("status = 'success'"), "source", "rows_read", "rows_inserted") == [
        ("order_status", 4, 1)
    ]
    assert all(r.rows_inserted == 0 for r in jobs.build_silver(store, "s2", NOW))
    gold_again = jobs.build_gold(store, TODAY, NOW)
    assert all(r.rows_inserted == 0 for r in gold_again[:6])
    assert store.rows("gold.dim_customers").agg(F.max("customer_sk")).first()[0] == 2
    first = store.rows("silver.orders").filter("order_id = 'o1'").first()
    assert first.latest_logistics_status == "shipped"
    # ... unless the upsert policy is chosen.
    jobs.build_silver(store, "s4", NOW, policy="upsert")
    jobs.build_gold(store, date(2024, 3, 2), NOW, policy="upsert", keep_snapshots=True)
    updated = store.rows("gold.fact_orders").filter("order_id = 'o1'").first()
    assert (updated.latest_logistics_status, updated.is_cancelled) == ("cancelled", True)
    assert store.rows("gold.fact_orders").count() == 4
    snapshots = store.rows("gold.delivery_performance")
    assert rows(snapshots, "snapshot_date", "cancelled_orders") == [
        (TODAY, 1),
        (date(2024, 3, 2), 2),
    ]
    latest = dashboard.latest_delivery(snapshots).first()
    assert latest.snapshot_date == date(2024, 3, 2)


def test_missing_and_empty_shop_files_are_skipped(store, tmp_path):
    header = SHOP["customers.csv"].splitlines()[0] + "\n"
    folder = write(tmp_path / "shop", {"customers.csv": header, "orders.csv": SHOP["orders.csv"]})
    (tmp_path / "shop" / "products.csv").write_text("product_id,product_category_name\np1,toys\n")
    got = jobs.load_shop_files(store, folder, "b1", NOW)
    assert rows(got, "source", "status", "reason") == [
        ("customers.csv", "skipped", "empty_file"),
        ("order_items.csv", "skipped", "file_not_found"),
        ("orders.csv", "success", None),
        (
            "products.csv",
            "success",
            "missing columns: product_name_lenght, product_description_lenght, product_photos_qty, "
            "product_weight_g, product_length_cm, product_height_cm, product_width_cm",
        ),
    ]
    with pytest.raises(FileNotFoundError):
        jobs.load_shop_files(store, str(tmp_path / "nowhere"), "b1", NOW)


def test_files_with_other_headers_load_by_name_and_rows_under_unknown_headers_are_rejected(store, tmp_path):
    reordered = "file_date,status,order_id,status_timestamp\n2024-01-09,shipped,o7,2024-01-09 00:00:00\n"
    feeds = write(
        tmp_path / "feeds",
        {"order_status/a.csv": STATUS, "order_status/b.csv": reordered, "order_status/c.csv": "x,y\n1,2\n"},
    )
    got = jobs.load_feeds(store, feeds, "run-1", NOW)
    assert rows(got.filter("source = 'order_status'"), "status", "rows_read", "rows_inserted") == [("success", 5, 4)]
    o7 = store.rows("bronze.order_status").filter("order_id = 'o7'").first()
    assert (o7.status, o7.file_date, o7._file_name) == ("shipped", date(2024, 1, 9), "b.csv")
    assert rows(store.rows("logs.file_ingestion_log"), "file_name", "rows_loaded", "rows_inserted") == [
        ("a.csv", 3, 3),
        ("b.csv", 1, 1),
        ("c.csv", 1, 0),
    ]


def test_file_counts_belong_to_paths_not_to_base_names(store, tmp_path):
    head = STATUS.splitlines()[0] + "\n"
    line = "{},shipped,2024-01-02 00:00:00,,,WH-01,,hub,2024-01-02\n"
    feeds = write(
        tmp_path / "feeds",
        {
            "order_status/one/a.csv": head + line.format("o1"),
            "order_status/two/a.csv": head + line.format("o2") + line.format("o3"),
            "order_status/two/my file+.csv": head + line.format("o4"),
        },
    )
    jobs.load_feeds(store, feeds, "run-1", NOW)
    log = store.rows("logs.file_ingestion_log").withColumn("folder", F.element_at(F.split("file_path", "/"), -2))
    assert rows(log, "folder", "file_name", "rows_loaded", "rows_inserted") == [
        ("one", "a.csv", 1, 1),
        ("two", "a.csv", 2, 2),
        ("two", "my file+.csv", 1, 1),
    ]
    assert "_file_uri" not in store.read("bronze.order_status").columns


def test_a_failing_feed_is_logged_and_does_not_stop_the_others(store, tmp_path, monkeypatch):
    feeds = write(tmp_path / "feeds", {"order_status/a.csv": STATUS, "returns/r.csv": RETURNS})
    read = jobs.csv.read_named

    def broken(spark, paths, *args, **named):
        if "order_status" in paths[0]:
            raise OSError("disk gone")
        return read(spark, paths, *args, **named)

    monkeypatch.setattr(jobs.csv, "read_named", broken)
    got = jobs.load_feeds(store, feeds, "run-1", NOW)
    assert rows(got, "source", "status", "reason") == [
        ("inventory", "skipped", "no_files"),
        ("order_status", "failed", "disk gone"),
        ("returns", "success", None),
    ]
    assert rows(store.rows("logs.file_ingestion_log"), "file_name", "status") == [
        ("a.csv", "failed"),
        ("r.csv", "processed"),
    ]
    # A failed file is offered again by the next run.
    monkeypatch.undo()
    again = jobs.load_feeds(store, feeds, "run-2", NOW)
    assert rows(again.filter("source = 'order_status'"), "status", "rows_inserted") == [("success", 3)]


def test_readiness_fails_on_empty_gold(store):
    store.bootstrap(dashboard.REQUIRED_TABLES)
    with pytest.raises(ValueError, match="gold.fact_orders"):
        jobs.check_ready(store)


HEADER = ",".join(f"h{i}" for i in range(19))


def trip(vendor, pickup, dropoff, passengers, distance, fare, tip="1.0"):
    return f"{vendor},{pickup},{dropoff},{passengers},{distance},0,0,1,N,0,0,card,{fare},0,0,{tip},0,0,{fare}"


def test_taxi_pipeline(store, tmp_path):
    a = [
        HEADER,
        trip(1, "2015-01-03 10:00:00", "2015-01-03 10:30:00", 1, 5.0, 20.0, 4.0),
        trip(1, "2015-01-03 10:00:00", "2015-01-03 10:30:00", 1, 5.0, 20.0, 4.0),
        trip(2, "2015-01-05 23:00:00", "2015-01-05 23:00:00", 1, 5.0, 20.0),
        trip(2, "2015-01-05 23:00:00", "2015-01-05 23:10:00", 0, 5.0, 20.0),
        trip("", "2015-01-05 23:00:00", "2015-01-05 23:10:00", 1, 5.0, 20.0),
    ]
    b = [HEADER, a[1], trip(2, "2015-01-05 23:00:00", "2015-01-05 23:10:00", 2, 1.0, 10.0)]
    folder = write(
        tmp_path / "taxi",
        {"2015/yellow_tripdata_1.csv": "\n".join(a), "yellow_tripdata_2.csv": "\n".join(b), "other.csv": "x"},
    )
    report = jobs.load_trips(store, folder, NOW)
    assert (report.rows_attempted, report.rows_rejected, report.rows_inserted) == (5, 1, 2)
    assert rows(store.rows("taxi.loaded_files"), "filename", "rows_staged") == [
        ("yellow_tripdata_1.csv", 3),
        ("yellow_tripdata_2.csv", 2),
    ]
    assert jobs.load_trips(store, folder, NOW) is None
    jobs.build_trips_clean(store, "run-1", NOW)
    assert rows(
        store.rows("taxi.trips_clean"),
        "trip_duration_minutes", "avg_speed_mph", "tip_percentage", "pickup_hour", "pickup_day_of_week", "is_weekend",
    ) == [
        (Decimal("10.00"), Decimal("6.00"), Decimal("10.00"), 23, "Monday", False),
        (Decimal("30.00"), Decimal("10.00"), Decimal("20.00"), 10, "Saturday", True),
    ]
    assert rows(store.rows("taxi.pipeline_runs"), "task_stage", "rows_processed") == [("dq_check_silver", 2)]
    with pytest.raises(FileNotFoundError):
        jobs.load_trips(store, write(tmp_path / "empty", {"other.csv": "x"}), NOW)


def test_clean_gate_stops_on_an_empty_table(store):
    store.bootstrap(["taxi.trips"])
    with pytest.raises(ValueError, match="taxi.trips.empty_table"):
        jobs.build_trips_clean(store, "run-1", NOW)


def test_bulk_append_reports_deltas_and_rolls_back_bad_files(store, tmp_path):
    good = trip(1, "2015-01-03 10:00:00", "2015-01-03 10:30:00", 1, 5.0, 20.0)
    folder = write(
        tmp_path / "taxi",
        {
            "yellow_tripdata_1.csv": "\n".join([HEADER, good, good]),
            "yellow_tripdata_2.csv": "\n".join([HEADER, good, good.replace("1,2015", "x,2015", 1)]),
            "yellow_tripdata_3.csv": "\n".join([HEADER, good]),
        },
    )
    got = jobs.append_trip_files(store, folder)
    assert rows(got) == [
        ("yellow_tripdata_1.csv", "success", 0, 2, 2),
        ("yellow_tripdata_2.csv", "failed", 2, 0, 2),
        ("yellow_tripdata_3.csv", "success", 2, 1, 3),
    ]


def test_stream_picks_up_only_new_files_and_never_duplicates(store, tmp_path):
    feed = next(f for f in PARTNER_FEEDS if f.location == "order_status")
    folder = write(tmp_path / "landing", {"a.csv": STATUS})
    checkpoint = str(tmp_path / "checkpoint")
    assert stream_feed(store, feed, folder, checkpoint, NOW) == 3
    assert stream_feed(store, feed, folder, checkpoint, NOW) == 3
    write(tmp_path / "landing", {"b.csv": STATUS + "o9,pending,2024-02-01 00:00:00,,,WH-01,,hub,2024-02-01\n"})
    assert stream_feed(store, feed, folder, checkpoint, NOW) == 4
    # Replaying everything from scratch still adds nothing.
    assert stream_feed(store, feed, folder, str(tmp_path / "other"), NOW) == 4
