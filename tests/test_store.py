from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from conftest import rows

from silverlode.schemas import TABLES, TableSpec
from silverlode.sinks import TableStore

SPECS = {
    s.name: s
    for s in (
        TableSpec("x.plain", "k INT, v STRING", ("k",), defaults={"v": "none"}),
        TableSpec("x.bucketed", "k INT, v STRING", ("k",), buckets=4),
        TableSpec("x.monthly", "k INT, d DATE", ("k",), partition_by=("month", "d")),
    )
}


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path), SPECS)


def frame(spark, data, schema="k INT, v STRING"):
    return spark.createDataFrame(data, schema)


def test_insert_if_absent_keeps_the_first_value(spark, store):
    first = store.insert_if_absent("x.plain", frame(spark, [(1, "a"), (1, "b"), (None, "z"), (2, "c")]))
    assert (first.rows_attempted, first.rows_rejected, first.rows_inserted) == (4, 1, 2)
    again = store.insert_if_absent("x.plain", frame(spark, [(1, "new"), (3, "d")]))
    assert (again.rows_before, again.rows_inserted, again.rows_after) == (2, 1, 3)
    assert rows(store.rows("x.plain")) == [(1, "a"), (2, "c"), (3, "d")]
    rejected = spark.read.parquet(store.path("x.plain") + "_rejects")
    assert rows(rejected) == [(None, "z")]


def test_rerun_of_the_same_batch_inserts_nothing(spark, store):
    batch = frame(spark, [(1, "a"), (2, "b")])
    store.insert_if_absent("x.plain", batch)
    assert store.insert_if_absent("x.plain", batch).rows_inserted == 0


def test_defaults_fill_absent_and_null_columns(spark, store):
    store.append("x.plain", frame(spark, [(1,)], "k INT"))
    store.append("x.plain", frame(spark, [(2, None)]))
    assert rows(store.rows("x.plain")) == [(1, "none"), (2, "none")]


@pytest.mark.parametrize("table", ["x.plain", "x.bucketed"])
def test_upsert_replaces_by_key(spark, store, table):
    store.upsert(table, frame(spark, [(i, "old") for i in range(20)]))
    report = store.upsert(table, frame(spark, [(3, "new"), (99, "new")]))
    assert (report.rows_before, report.rows_inserted, report.rows_after) == (20, 1, 21)
    got = dict(rows(store.rows(table)))
    assert got[3] == "new" and got[4] == "old" and got[99] == "new"


def test_upsert_order_picks_the_last_row_of_a_batch(spark, store):
    store.upsert("x.plain", frame(spark, [(1, "a"), (1, "c"), (1, "b")]), order_by=["v"])
    assert rows(store.rows("x.plain")) == [(1, "c")]


def test_bucketed_upsert_leaves_other_buckets_alone(spark, store):
    store.upsert("x.bucketed", frame(spark, [(i, "old") for i in range(40)]))

    def files():
        return set(store.read("x.bucketed").inputFiles())

    before = files()
    store.upsert("x.bucketed", frame(spark, [(7, "new")]))
    untouched = before & files()
    assert untouched and len(untouched) < len(before)


def test_replace_can_read_the_table_it_overwrites(spark, store):
    store.append("x.plain", frame(spark, [(1, "a"), (2, "b")]))
    store.replace("x.plain", store.rows("x.plain").filter("k = 2"), reads_itself=True)
    assert rows(store.rows("x.plain")) == [(2, "b")]


def test_monthly_layout_prunes_and_round_trips(spark, store):
    data = [(1, date(2024, 1, 5)), (2, date(2024, 2, 6)), (3, None)]
    store.insert_if_absent("x.monthly", frame(spark, data, "k INT, d DATE"))
    assert rows(store.rows("x.monthly")) == [(1, date(2024, 1, 5)), (2, date(2024, 2, 6)), (3, None)]
    january = store.read("x.monthly").filter("month = DATE'2024-01-01'")
    assert "PartitionFilters: [isnotnull(month" in january._jdf.queryExecution().executedPlan().toString()
    assert rows(january, "k") == [(1,)]


def test_small_batch_against_a_large_table_broadcasts_the_batch(spark, store):
    store.append("x.plain", spark.range(200_000).selectExpr("CAST(id AS INT) AS k", "'old' AS v"))
    staged = store.stage("x.plain", frame(spark, [(5, "x"), (999_999, "y")]))
    fresh = store.fresh_rows("x.plain", staged)
    assert rows(fresh) == [(999_999, "y")]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_bootstrap_creates_every_table_empty(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    names = ["bronze.sellers", "gold.fact_orders", "logs.file_ingestion_log"]
    store.bootstrap(names)
    store.bootstrap(names)
    for name in names:
        assert store.exists(name) and store.read(name).count() == 0
        assert store.rows(name).schema.names == TABLES[name].schema.names


def test_money_is_cast_to_the_table_type(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.append("bronze.order_items", frame(spark, [("o", 1, "9.999")], "order_id STRING, order_item_id INT, price STRING"))
    assert rows(store.rows("bronze.order_items"), "price") == [(Decimal("10.00"),)]


def test_upsert_sets_null_keys_aside(spark, tmp_path):
    from silverlode.sinks.tables import TableStore

    store = TableStore(spark, str(tmp_path))
    batch = spark.createDataFrame([("r", 2**31 + 5, None, None), (None, 1, None, None)], "return_reason string, return_count long, total_refund_amount decimal(16,2), pct_of_all_returns decimal(8,4)")
    report = store.upsert("gold.return_rate_by_reason", batch)
    assert report.rows_rejected == 1
    assert [r.return_count for r in store.read("gold.return_rate_by_reason").collect()] == [2**31 + 5]
    assert spark.read.parquet(store.path("gold.return_rate_by_reason") + "_rejects").count() == 1
