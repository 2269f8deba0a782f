from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverlode.operators import (
    Reference,
    Rule,
    absent_from,
    check_references,
    check_rules,
    first_per_key,
    latest_per_key,
    merge_rows,
    number_rows,
    raise_on_critical,
    running_delta,
    share_of_total,
    split_null_keys,
    summarize,
    top_rows,
    update_columns,
)

RELAXED = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
PAIRS = st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 9))), max_size=25)


def frame(spark, data, schema="k INT, v INT"):
    return spark.createDataFrame(data, schema)


@RELAXED
@given(PAIRS)
def test_first_per_key_is_smallest_row_nulls_first(spark, data):
    expected = {}
    for k, v in data:
        rank = (v is not None, v or 0)
        if k not in expected or rank < expected[k][0]:
            expected[k] = (rank, v)
    assert rows(first_per_key(frame(spark, data), ["k"])) == sorted(
        ((k, v) for k, (_, v) in expected.items()), key=repr
    )


@RELAXED
@given(PAIRS, PAIRS)
def test_insert_then_insert_again_adds_nothing(spark, stored, incoming):
    target = first_per_key(frame(spark, stored), ["k"])
    fresh = absent_from(first_per_key(frame(spark, incoming), ["k"]), target, ["k"])
    both = target.unionByName(fresh)
    assert both.count() == both.select("k").distinct().count()
    assert {k for k, _ in rows(both)} == {k for k, _ in stored} | {k for k, _ in incoming}
    assert absent_from(frame(spark, incoming), both, ["k"]).count() == 0


@RELAXED
@given(PAIRS, PAIRS)
def test_merge_is_last_write_wins(spark, stored, incoming):
    target = first_per_key(frame(spark, stored), ["k"])
    batch = first_per_key(frame(spark, incoming), ["k"])
    expected = dict(rows(target)) | dict(rows(batch))
    assert dict(rows(merge_rows(target, batch, ["k"]))) == expected


def test_latest_per_key_orders_nulls_last_and_breaks_ties(spark):
    data = [("a", 1, "x"), ("a", None, "z"), ("b", 5, "p"), ("b", 5, "q"), ("c", None, "only")]
    got = latest_per_key(frame(spark, data, "k STRING, ts INT, s STRING"), ["k"], ["ts", "s"])
    assert rows(got) == [("a", 1, "x"), ("b", 5, "q"), ("c", None, "only")]


def test_split_null_keys_loses_nothing(spark):
    df = frame(spark, [(1, 2), (None, 3), (4, None)])
    good, bad = split_null_keys(df, ["k"])
    assert rows(good) == [(1, 2), (4, None)]
    assert rows(bad) == [(None, 3)]


def test_update_columns_overwrites_matches_only(spark):
    target = frame(spark, [(1, 10), (2, 20), (3, None)])
    updates = frame(spark, [(1, 11), (2, None)])
    assert rows(update_columns(target, updates, ["k"], ["v"])) == [(1, 11), (2, None), (3, None)]


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_number_rows_is_dense_per_group_with_a_hot_group(spark, partitions):
    data = [("hot", f"{i:05d}") for i in range(3000)] + [("cold", "b"), ("cold", "a"), ("z", "only")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = number_rows(frame(spark, data, "g STRING, k STRING"), ["k"], "n", group_by=["g"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    by_group = {}
    for r in got:
        by_group.setdefault(r.g, []).append((r.k, r.n))
    for group in by_group.values():
        ordered = sorted(group)
        assert [n for _, n in ordered] == list(range(1, len(ordered) + 1))
    assert len(got) == len(data)


def test_number_rows_spreads_a_hot_group_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = spark.range(20000).select(F.lit("hot").alias("g"), F.col("id").cast("string").alias("k"))
        sliced = number_rows(hot, ["k"], "n", group_by=["g"])
        slices = [f for f in sliced.inputFiles() if "/numbered-" in f]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(slices) == 4
    assert sliced.agg(F.max("n"), F.count_distinct("n")).first() == (20000, 20000)


def test_number_rows_continues_after_existing_keys(spark):
    got = number_rows(frame(spark, [(3, 0), (1, 0), (2, 0)]), ["k"], "sk", after=40)
    assert rows(got, "k", "sk") == [(1, 41), (2, 42), (3, 43)]


def test_number_rows_of_nothing(spark):
    assert number_rows(frame(spark, []), ["k"], "sk", after=5).count() == 0


def test_share_of_total_has_no_single_partition_window(spark):
    counts = frame(spark, [(1, 1), (2, 2)]).groupBy("k").agg(F.sum("v").alias("n"))
    shared = counts.withColumn("share", share_of_total(counts, "n", 4, "decimal(8,4)"))
    assert rows(shared, "k", "share") == [(1, Decimal("0.3333")), (2, Decimal("0.6667"))]
    assert "Window" not in shared._jdf.queryExecution().executedPlan().toString()


def test_top_rows_is_planned_as_top_k(spark):
    best = top_rows(frame(spark, [(1, 5), (2, None), (3, 9)]), [F.col("v").desc_nulls_last()], 2)
    assert [tuple(r) for r in best.collect()] == [(3, 9), (1, 5)]
    assert "TakeOrderedAndProject" in best._jdf.queryExecution().executedPlan().toString()


def test_running_delta(spark):
    got = running_delta(frame(spark, [("b", 5), ("a", 3)], "f STRING, n INT"), "f", "n", start=10)
    assert rows(got) == [("a", 10, 3, 13), ("b", 13, 5, 18)]


RULES = [
    Rule("t", "null_k", "null_check", True, "k IS NULL"),
    Rule("t", "bad_v", "range", False, "v IS NULL OR v < 0"),
    Rule("t", "empty_table", "volume", False),
]


def test_rules_report_counts_status_and_percentage(spark):
    df = frame(spark, [(1, 1), (None, -1), (3, None)])
    got = {r.check_name: r for r in check_rules({"t": df}, RULES).collect()}
    assert (got["null_k"].status, got["null_k"].rows_failed) == ("failed", 1)
    assert got["null_k"].failure_percentage == Decimal("33.3333")
    assert (got["bad_v"].status, got["bad_v"].rows_failed) == ("warning", 2)
    assert got["empty_table"].status == "passed"


def test_rules_on_an_empty_table(spark):
    got = {r.check_name: r for r in check_rules({"t": frame(spark, [])}, RULES).collect()}
    assert (got["empty_table"].status, got["empty_table"].rows_failed) == ("warning", 1)
    assert got["null_k"].status == "passed"
    assert got["null_k"].failure_percentage is None


def test_rules_of_one_table_share_one_scan(spark):
    plan = check_rules({"t": frame(spark, [(1, 1)])}, RULES)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1


def test_references_count_nulls_and_unknown_keys_as_orphans(spark):
    parent = frame(spark, [("1",), ("2",)], "order_id STRING")
    child = frame(spark, [("1",), ("1",), ("9",), (None,)], "order_id STRING")
    clean = frame(spark, [("2",)], "order_id STRING")
    got = check_references(
        {"p": parent, "c": child, "d": clean}, [Reference("c", "p", "order_id"), Reference("d", "p", "order_id")]
    )
    assert rows(got, "table_name", "status", "rows_checked", "rows_failed") == [
        ("c", "warning", 4, 2),
        ("d", "passed", 1, 0),
    ]


def test_unique_rule_counts_surplus_rows_in_the_same_pass(spark):
    df = frame(spark, [(1, 0), (1, 1), (2, -1), (1, 2)])
    checked = check_rules({"t": df}, [Rule("t", "dup_k", "unique", True, key=("k",)), RULES[1], RULES[2]])
    assert rows(checked, "check_name", "status", "rows_checked", "rows_failed") == [
        ("bad_v", "warning", 4, 1),
        ("dup_k", "failed", 4, 2),
        ("empty_table", "passed", 4, 0),
    ]
    assert checked._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_unique_rule_on_an_empty_table(spark):
    got = check_rules({"t": frame(spark, [])}, [Rule("t", "dup_k", "unique", True, key=("k",)), RULES[2]])
    assert rows(got, "check_name", "status", "rows_failed") == [("dup_k", "passed", 0), ("empty_table", "warning", 1)]


def test_critical_failure_stops_the_run(spark):
    results = check_rules({"t": frame(spark, [(None, 1)])}, RULES)
    assert tuple(summarize(results).first()) == (3, 1, 0)
    with pytest.raises(ValueError, match="t.null_k=1"):
        raise_on_critical(results)


# --- constraints ----------------------------------------------------------------------
def test_constraints_split_rows_in_one_pass_and_name_what_failed(spark):
    from silverlode.operators.constraints import check, enforce, failure_counts, not_null, split_rows

    rules = [*not_null("k", "a.b"), check("positive", "v > 0"), check("short", "char_length(`a.b`) < 3")]
    data = [(1, "x", 5), (None, "y", 1), (2, None, -1), (3, "long", None), (4, "", 0)]
    df = spark.createDataFrame(data, "k INT, `a.b` STRING, v INT")
    kept, rejected = split_rows(df, rules)
    assert rows(kept) == [(1, "x", 5)] and kept.columns == df.columns
    assert {r.k: r._failed for r in rejected.collect()} == {
        None: ["k_not_null"], 2: ["a.b_not_null", "positive"], 3: ["short"], 4: ["positive"]
    }
    assert rows(failure_counts(df, rules)) == sorted(
        [("k_not_null", 1, 5), ("a.b_not_null", 1, 5), ("positive", 2, 5), ("short", 1, 5)], key=repr
    )
    assert rows(enforce(df.where("k = 1"), rules)) == [(1, "x", 5)]
    with pytest.raises(Exception, match="violated constraints: a.b_not_null, positive"):
        enforce(df.where("k = 2"), rules).collect()
    assert split_rows(df.limit(0), rules)[0].isEmpty() and split_rows(df, [])[0].count() == 5
    with pytest.raises(ValueError):
        split_rows(df, rules * 16)


def test_required_columns_set_rows_aside(spark, tmp_path):
    from silverlode.schemas import TableSpec
    from silverlode.sinks import TableStore

    store = TableStore(spark, str(tmp_path), {"x.t": TableSpec("x.t", "k INT, v STRING", ("k",), not_null=("v",))})
    report = store.insert_if_absent("x.t", spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "k INT, v STRING"))
    assert (report.rows_rejected, report.rows_inserted) == (2, 1)
    assert rows(store.rows("x.t")) == [(1, "a")] and spark.read.parquet(store.path("x.t") + "_rejects").count() == 2
