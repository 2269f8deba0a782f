"""The pipelines as callable jobs against a :class:`TableStore`.

Each step is one Spark job chain that reads stored tables and writes one stored
table; a scheduler calls them in the order given here.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.operators.numbering import pin
from silverlode.operators.quality import raise_on_critical, run_checks, summarize
from silverlode.plans import bronze, dashboard, gold, incremental, silver, taxi
from silverlode.plans.checks import BRONZE_REFERENCES, BRONZE_RULES
from silverlode.schemas import FX_SOURCE, PARTNER_FEEDS, SHOP_FILES, TABLES, FileSource
from silverlode.session import path_exists
from silverlode.sinks.tables import LoadReport, TableStore
from silverlode.sources import csv, csv_blocks, files, rates

FILE_LOG = "logs.file_ingestion_log"
STATUS_SCHEMA = "source STRING, table_name STRING, status STRING, reason STRING, rows_read BIGINT, rows_inserted BIGINT"


def _status(store: TableStore, rows: list[tuple]) -> DataFrame:
    return store.spark.createDataFrame(rows, STATUS_SCHEMA)


# --- bronze -------------------------------------------------------------------------
def load_shop_files(
    store: TableStore, folder: str, batch_id: str, loaded_at: datetime, parallel: bool = False
) -> DataFrame:
    """Load the one-file-per-table CSVs; missing and empty files are reported and skipped, missing columns noted.

    ``parallel`` reads a file by many tasks (see :mod:`silverlode.sources.csv_blocks`).
    """
    read_named = csv_blocks.read_named if parallel else csv.read_named
    if not path_exists(store.spark, folder):
        raise FileNotFoundError(f"raw folder not found: {folder}")
    outcome = []
    for source in SHOP_FILES:
        path = f"{folder.rstrip('/')}/{source.location}"
        if not path_exists(store.spark, path):
            outcome.append((source.location, source.table, "skipped", "file_not_found", 0, 0))
            continue
        rows = read_named(store.spark, path, source.schema).drop(csv.FILE_COLUMN)
        if rows.isEmpty():
            outcome.append((source.location, source.table, "skipped", "empty_file", 0, 0))
            continue
        absent = csv.missing_columns(csv.header_of(store.spark, [path]), source.schema)
        note = f"missing columns: {', '.join(absent)}" if absent else None
        report = _land(store, source, rows, batch_id, loaded_at)
        outcome.append(
            (source.location, source.table, report.status, note, report.rows_attempted, report.rows_inserted)
        )
    return _status(store, outcome)


def _land(
    store: TableStore, source: FileSource, rows: DataFrame, batch_id: str, loaded_at: datetime
) -> LoadReport:
    landed = bronze.with_lineage(rows, source.table, source.source_system, batch_id, loaded_at)
    return store.insert_if_absent(source.table, landed)


def load_feeds(store: TableStore, landing: str, run_id: str, loaded_at: datetime) -> DataFrame:
    """Load every partner feed: changed files only, one scan per feed, outcome logged per file.

    A feed that fails is reported and does not stop the others.  The file log is
    written after the rows, so a crash in between only means that the files are
    offered again and insert nothing.
    """
    outcome, logs = [], []
    for feed in PARTNER_FEEDS:
        folder = f"{landing.rstrip('/')}/{feed.location}"
        if not path_exists(store.spark, folder):
            outcome.append((feed.location, feed.table, "skipped", "no_files", 0, 0))
            continue
        new_files = _new_files(store, feed, folder)
        if new_files is None:
            outcome.append((feed.location, feed.table, "skipped", "already_processed", 0, 0))
            continue
        try:
            report, log = load_feed(store, feed, new_files, run_id, loaded_at)
            outcome.append(
                (feed.location, feed.table, "success", None, report.rows_attempted, report.rows_inserted)
            )
        except Exception as error:  # noqa: BLE001 - reported in the status frame and the file log
            outcome.append((feed.location, feed.table, "failed", str(error), 0, 0))
            log = new_files.withColumn("status", F.lit("failed"))
        logs.append(store.conform(log.withColumn("run_id", F.lit(run_id)), FILE_LOG))
    if logs:
        entries = reduce(DataFrame.unionByName, logs)
        store.upsert(FILE_LOG, entries.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp")))
    return _status(store, outcome)


def _new_files(store: TableStore, feed: FileSource, folder: str) -> DataFrame | None:
    """The feed's files that the log does not list as processed; None when there are none."""
    found = files.fingerprints(store.spark, folder).withColumn("source_system", F.lit(feed.source_system))
    columns = "source_system STRING, file_name STRING, file_path STRING, file_size_bytes BIGINT, file_checksum STRING, _file_uri STRING"
    listed = (
        files.changed_files(found, store.rows(FILE_LOG))
        .select("source_system", "file_name", "path", "file_size_bytes", "file_checksum", "uri")
        .collect()
    )
    return store.spark.createDataFrame(listed, columns) if listed else None


def load_feed(
    store: TableStore, feed: FileSource, new_files: DataFrame, run_id: str, loaded_at: datetime
) -> tuple[LoadReport, DataFrame]:
    """Insert the rows of new files; returns the load report and the log entry of every file.

    Files are read in one scan with a common header; if their headers differ, there is
    one scan per header instead.
    """
    paths = [row.file_path for row in new_files.collect()]

    def staged_rows(rows: DataFrame) -> DataFrame:
        landed = bronze.with_lineage(rows, feed.table, feed.source_system, run_id, loaded_at)
        return store.stage(feed.table, landed, extra=[csv.URI_COLUMN])

    try:
        staged = staged_rows(csv.read_named(store.spark, paths, feed.schema, uri=True))
    except Exception:  # noqa: BLE001 - only different headers are handled here
        groups = csv.paths_by_header(store.spark, paths)
        if len(groups) < 2:
            raise
        staged = staged_rows(csv.read_mixed(store.spark, groups, feed.schema, uri=True))
    fresh = pin(store.fresh_rows(feed.table, staged), "fresh")
    report = store.insert_fresh(feed.table, staged, fresh)
    log = (
        new_files.join(_per_file(staged, "rows_loaded"), csv.URI_COLUMN, "left")
        .join(_per_file(fresh, "rows_inserted"), csv.URI_COLUMN, "left")
        .fillna(0, ["rows_loaded", "rows_inserted"])
        .withColumn("status", F.lit("processed"))
    )
    return report, log


def _per_file(rows: DataFrame, measure: str) -> DataFrame:
    return rows.groupBy(csv.URI_COLUMN).agg(F.count(F.lit(1)).alias(measure))


def load_rates(
    store: TableStore, folder: str, start: date, end: date, batch_id: str, loaded_at: datetime
) -> tuple[LoadReport | None, DataFrame]:
    """Load landed rate payloads; also returns the requested dates that have no payload."""
    payloads = rates.read_payloads(store.spark, folder).filter(
        F.col("requested_date").between(F.lit(start), F.lit(end))
    )
    bounds = store.spark.createDataFrame([(start, end)], "start DATE, end DATE")
    landed_dates = payloads.select(F.col("requested_date").alias("date")).distinct()
    missing = rates.missing_dates(rates.date_spine(bounds), landed_dates)
    rows = rates.flatten_payloads(payloads)
    if rows.isEmpty():
        return None, missing
    landed = bronze.with_lineage(rows, "bronze.currency_rates", FX_SOURCE, batch_id, loaded_at)
    return store.insert_if_absent("bronze.currency_rates", landed), missing


# --- quality gate -----------------------------------------------------------------
def check_bronze(
    store: TableStore, run_id: str, checked_at: datetime, fail_on_critical: bool = True
) -> DataFrame:
    """Run the bronze rules, store the results, then stop the run on a critical failure."""
    names = dict.fromkeys([r.table for r in BRONZE_RULES] + [r.parent for r in BRONZE_REFERENCES])
    results = run_checks({n: store.rows(n) for n in names}, BRONZE_RULES, BRONZE_REFERENCES)
    record_checks(store, results, "bronze", run_id, checked_at)
    stored = store.rows("logs.data_quality_results").filter(F.col("run_id") == run_id)
    if fail_on_critical:
        raise_on_critical(stored)
    return summarize(stored)


def record_checks(
    store: TableStore, results: DataFrame, layer: str, run_id: str, checked_at: datetime
) -> None:
    """Store the outcome of every check; a repeated run of one ``run_id`` replaces its own."""
    details = F.to_json(
        F.struct(
            "critical",
            F.col("rows_failed").alias("failed_rows"),
            F.col("rows_checked").alias("total_rows"),
        )
    )
    store.upsert(
        "logs.data_quality_results",
        results.withColumns(
            {
                "run_id": F.lit(run_id),
                "layer": F.lit(layer),
                "details": details,
                "checked_at": F.lit(checked_at).cast("timestamp"),
            }
        ),
    )


# --- silver and gold ----------------------------------------------------------------
def _pending(store: TableStore, source: str, target: str, policy: str) -> DataFrame | None:
    """Source rows to transform: under insert-if-absent those whose key the target lacks.

    Only key columns are compared, and only the rows behind the pending keys are
    read on.  A small increment is a broadcast semi-join over a scan of the source,
    so neither table's full rows are shuffled.  None when nothing is pending.
    """
    rows = store.rows(source)
    if policy == "upsert" or not store.exists(target):
        return rows
    keys = list(TABLES[target].keys)
    stored = store.rows(target).select(*keys)
    pending = pin(rows.select(*keys).join(stored, keys, "left_anti"), "pending-keys")
    return None if pending.isEmpty() else rows.join(pending, keys, "left_semi")


def _publish(store: TableStore, table: str, df: DataFrame | None, policy: str) -> LoadReport:
    """Write transformed pending rows: their keys are unique and new, so an append is enough."""
    if df is None:
        rows = store.read(table).count()
        return LoadReport(table, 0, 0, rows, 0, rows)
    return store.upsert(table, df) if policy == "upsert" else store.append(table, df)


def build_silver(
    store: TableStore, batch_id: str, loaded_at: datetime, policy: str = "insert_if_absent"
) -> list[LoadReport]:
    """Clean every bronze table into silver.  ``policy`` is ``insert_if_absent`` or ``upsert``."""
    steps: list[tuple[str, str, Callable[[DataFrame], DataFrame]]] = [
        ("bronze.customers", "silver.customers", silver.customers),
        ("bronze.products", "silver.products", silver.products),
        (
            "bronze.orders",
            "silver.orders",
            lambda rows: silver.orders(rows, store.rows("bronze.order_status")),
        ),
        ("bronze.order_items", "silver.order_items", silver.order_items),
        ("bronze.returns", "silver.returns", silver.returns),
        ("bronze.inventory_snapshots", "silver.inventory", silver.inventory),
    ]
    stamp = bronze.stamp(batch_id, loaded_at)
    reports = []
    for source, target, transform in steps:
        rows = _pending(store, source, target, policy)
        cleaned = None if rows is None else transform(rows).withColumns(stamp)
        reports.append(_publish(store, target, cleaned, policy))
    # Currency codes change case in silver, so bronze keys cannot tell what is pending.
    quotes = silver.currency_rates(store.rows("bronze.currency_rates")).withColumns(stamp)
    write = store.upsert if policy == "upsert" else store.insert_if_absent
    return [*reports, write("silver.currency_rates", quotes)]


def build_gold(
    store: TableStore,
    as_of: date,
    loaded_at: datetime,
    policy: str = "insert_if_absent",
    keep_snapshots: bool = False,
    incremental_kpis: bool = False,
) -> list[LoadReport]:
    """Star schema first, then the KPI tables that read it.

    KPI tables are computed from all facts, or with ``incremental_kpis`` from stored sums
    to which the facts of this load are added (see :mod:`silverlode.plans.incremental`;
    each load needs its own ``loaded_at``).  ``keep_snapshots`` keeps one delivery row
    per day instead of only the latest.
    """
    if incremental_kpis and policy == "upsert":
        raise ValueError("replaced facts must be named: use incremental.apply_orders and apply_sales")
    loaded = {"_loaded_at": F.lit(loaded_at).cast("timestamp")}
    orders = store.rows("silver.orders")

    def dimension(source: str, table: str, key: str, build) -> LoadReport:
        """New dimension rows get the surrogate keys after the highest stored one."""
        rows = _pending(store, source, table, "insert_if_absent")
        if rows is None:
            return _publish(store, table, None, "insert_if_absent")
        last = store.rows(table).agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
        return store.append(table, build(rows, last).withColumns(loaded))

    def fact(source: str, table: str, build) -> LoadReport:
        rows = _pending(store, source, table, policy)
        return _publish(store, table, None if rows is None else build(rows).withColumns(loaded), policy)

    reports = [
        store.insert_if_absent("gold.dim_date", gold.dim_date(orders)),
        dimension("silver.customers", "gold.dim_customers", "customer_sk", gold.dim_customers),
        dimension("silver.products", "gold.dim_products", "product_sk", gold.dim_products),
    ]
    named = gold.name_products(store.rows("gold.dim_products"))
    store.replace("gold.dim_products", named, reads_itself=True)

    reports += [
        fact("silver.order_items", "gold.fact_order_items", lambda rows: gold.fact_order_items(rows, orders)),
        fact(
            "silver.orders",
            "gold.fact_orders",
            lambda rows: gold.fact_orders(rows, store.rows("silver.order_items"), store.rows("silver.returns")),
        ),
        fact("silver.returns", "gold.fact_returns", gold.fact_returns),
    ]

    products = store.rows("gold.dim_products")
    if incremental_kpis:
        incremental.apply_stored(store, loaded_at)
        daily = incremental.daily_sales_summary(store)
        performance = incremental.product_performance(store, products)
        reasons = incremental.return_rate_by_reason(store)
        delivery = incremental.delivery_performance(store, as_of)
    else:
        facts = store.rows("gold.fact_orders")
        returned = store.rows("gold.fact_returns")
        daily = gold.daily_sales_summary(facts)
        performance = gold.product_performance(products, store.rows("gold.fact_order_items"), returned)
        reasons = gold.return_rate_by_reason(returned)
        delivery = gold.delivery_performance(facts, as_of)
    delivery = delivery.withColumns(loaded)
    reports += [
        store.replace("gold.daily_sales_summary", daily.withColumns(loaded)),
        store.replace("gold.product_performance", performance.withColumns(loaded)),
        store.replace("gold.return_rate_by_reason", reasons.withColumns(loaded)),
        store.upsert("gold.delivery_performance", delivery)
        if keep_snapshots
        else store.replace("gold.delivery_performance", delivery),
    ]
    return reports


def check_ready(store: TableStore) -> DataFrame:
    """Readiness per dashboard table; an empty one stops the run."""
    state = dashboard.readiness({n: store.rows(n) for n in dashboard.REQUIRED_TABLES})
    empty = [row.table_name for row in state.filter(~F.col("is_ready")).collect()]
    if empty:
        raise ValueError(f"gold tables are empty: {', '.join(empty)}")
    return state


# --- taxi ---------------------------------------------------------------------------
def append_trip_files(
    store: TableStore, folder: str, pattern: str = "yellow_tripdata_*.csv", parallel: bool = False
) -> DataFrame:
    """Bulk append of every trip file, no de-duplication; reports the row count delta per file.

    A malformed file is rolled back (its append never commits) and the next one is tried.
    """
    listed = files.discover(store.spark, folder, pattern).orderBy("file_name").collect()
    outcome = []
    schema = TABLES["taxi.trips_raw"].schema
    read_positional = csv_blocks.read_positional if parallel else csv.read_positional
    for found in listed:
        try:
            rows = read_positional(store.spark, found.path, _trip_schema(schema), strict=True)
            report = store.append("taxi.trips_raw", rows.withColumn("source_file", F.lit(found.file_name)))
            outcome.append(
                (found.file_name, "success", report.rows_before, report.rows_inserted, report.rows_after)
            )
        except Exception:  # noqa: BLE001 - reported in the status frame
            before = store.read("taxi.trips_raw").count()
            outcome.append((found.file_name, "failed", before, 0, before))
    return store.spark.createDataFrame(
        outcome, "file STRING, status STRING, rows_before BIGINT, rows_added BIGINT, rows_after BIGINT"
    )


def _trip_schema(schema):
    return type(schema)([f for f in schema if f.name != "source_file"])


def load_trips(
    store: TableStore,
    folder: str,
    loaded_at: datetime,
    pattern: str = "yellow_tripdata_*.csv",
    parallel: bool = False,
) -> LoadReport | None:
    """Changed trip files: filter, hash, insert the new trips, record the files.

    ``parallel`` reads a file by many tasks (see :mod:`silverlode.sources.csv_blocks`).
    """
    read_positional = csv_blocks.read_positional if parallel else csv.read_positional
    found = files.fingerprints(store.spark, folder, pattern)
    seen = store.rows("taxi.loaded_files").select(F.col("filename").alias("file_name"), "file_checksum")
    fresh = found.join(seen, ["file_name", "file_checksum"], "left_anti").collect()
    if not fresh:
        if found.isEmpty():
            raise FileNotFoundError(f"no trip files under {folder}")
        return None
    staged = taxi.stage(
        read_positional(
            store.spark, [row.path for row in fresh], _trip_schema(TABLES["taxi.trips_raw"].schema)
        )
    )
    batch = store.stage(
        "taxi.trips", taxi.hashed(staged).withColumn("loaded_at", F.lit(loaded_at).cast("timestamp"))
    )
    report = store.insert_fresh("taxi.trips", batch, store.fresh_rows("taxi.trips", batch))
    counts = batch.groupBy(F.col("source_file").alias("filename")).agg(
        F.count(F.lit(1)).alias("rows_staged")
    )
    manifest = store.spark.createDataFrame(
        [(row.file_name, row.file_checksum) for row in fresh], "filename STRING, file_checksum STRING"
    )
    store.upsert(
        "taxi.loaded_files",
        manifest.join(counts, "filename", "left")
        .fillna(0, ["rows_staged"])
        .withColumn("loaded_at", F.lit(loaded_at).cast("timestamp")),
    )
    return report


def build_trips_clean(store: TableStore, run_id: str, run_at: datetime) -> LoadReport:
    """Gate the trips, rebuild the clean table, gate it and record the run."""
    raise_on_critical(taxi.gate_trips(store.rows("taxi.trips")))
    report = store.replace("taxi.trips_clean", taxi.clean(store.rows("taxi.trips")))
    raise_on_critical(taxi.gate_clean(store.rows("taxi.trips_clean")))
    store.append(
        "taxi.pipeline_runs",
        store.spark.createDataFrame(
            [(run_id, "dq_check_silver", report.rows_after, "success", run_at)],
            TABLES["taxi.pipeline_runs"].schema,
        ),
    )
    return report
