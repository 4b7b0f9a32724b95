"""The named queries over the given tables, one per operator of the engine."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tradeflow.operators import changelog, layout, quality
from tradeflow.operators.latest import mark_replaced
from tradeflow.plans import metrics, run, serving
from tradeflow.plans import validation as v
from tradeflow.plans.acceptance import acceptance_report, judge
from tradeflow.session import shared_folder, use_utc
from tradeflow.sources import feeds, raw, schemas, tables
from tradeflow.sources.schemas import REASON

Query = Callable[[SparkSession, str], DataFrame]

INGESTED_AT = "2026-01-01T00:00:00Z"
CHANNELS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
COMMITS = tuple(datetime(2026, 1, day, tzinfo=timezone.utc) for day in (1, 2, 10))
CUTOFF = datetime(2026, 1, 5, tzinfo=timezone.utc)

# How source files are delivered: as text, a feed takes about ten times the bytes of its table.
DELIVERED = "gzip"

# Lines no reader can parse into a full row, added to the feeds that are ingested from files.
BAD_ORDER_LINES = ("not json", '{"order_id": "ORD-1", "quan', "[1, 2")
BAD_PRICE_LINES = ("not json", '{"product_id": "SKU-1", "old', "[1, 2")
BAD_INVENTORY_LINES = ("SKU-1", "SKU-1,WH-1", "SKU-1,WH-1,5,BAD-TIMESTAMP,surplus")


# Feeds with fixed provenance.


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.add_provenance(feeds.raw_orders(spark, sf_dir), "lineitem", INGESTED_AT)


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.add_provenance(feeds.raw_inventory(spark, sf_dir), "lineitem", INGESTED_AT)


def raw_price_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.add_provenance(feeds.raw_price_events(spark, sf_dir), "events", INGESTED_AT)


def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.clean(raw_orders(spark, sf_dir), v.ORDERS)


def clean_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.clean(raw_inventory(spark, sf_dir), v.INVENTORY)


def clean_price_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.clean(raw_price_events(spark, sf_dir), v.PRICE_EVENTS)


def stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw orders as a stored table, as ingestion leaves them; its rows have an identity."""
    return tables.overwrite(raw_orders(spark, sf_dir), f"{shared_folder(spark)}/raw")


def labelled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.label_stored(stored_orders(spark, sf_dir), v.ORDERS)


def quarantine_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.select_quarantined(labelled_orders(spark, sf_dir), v.ORDERS)


def quarantine_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.quarantined(raw_inventory(spark, sf_dir), v.INVENTORY)


def quarantine_price_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.quarantined(raw_price_events(spark, sf_dir), v.PRICE_EVENTS)


# Ingest, sinks, whole runs.


def _write_with_bad_lines(feed: DataFrame, folder: str, format: str, bad: tuple[str, ...]) -> str:
    lines = bad
    if format == "csv":
        feed.write.option("header", True).option("compression", DELIVERED).csv(f"{folder}/good")
        lines = (",".join(feed.columns), *bad)
    else:
        feed.write.option("compression", DELIVERED).json(f"{folder}/good")
    spark = feed.sparkSession
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(f"{folder}/bad")
    return f"{folder}/*"


def source_files(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, str]:
    return {
        "orders": _write_with_bad_lines(
            feeds.raw_orders(spark, sf_dir), f"{folder}/orders", "json", BAD_ORDER_LINES
        ),
        "inventory": _write_with_bad_lines(
            feeds.raw_inventory(spark, sf_dir), f"{folder}/inventory", "csv", BAD_INVENTORY_LINES
        ),
        "price_events": _write_with_bad_lines(
            feeds.raw_price_events(spark, sf_dir), f"{folder}/price_events", "json", BAD_PRICE_LINES
        ),
    }


def _traced(table: DataFrame) -> DataFrame:
    traced = F.col(schemas.INGESTED_AT).isNotNull() & F.col(schemas.SOURCE_FILE).isNotNull()
    return table.withColumn("traced", traced).drop(*schemas.PROVENANCE)


def ingest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    source = _write_with_bad_lines(feeds.raw_orders(spark, sf_dir), f"{folder}/in", "json", BAD_ORDER_LINES)
    return _traced(raw.ingest_orders(spark, source, f"{folder}/raw"))


def ingest_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    source = _write_with_bad_lines(
        feeds.raw_inventory(spark, sf_dir), f"{folder}/in", "csv", BAD_INVENTORY_LINES
    )
    return _traced(raw.ingest_inventory(spark, source, f"{folder}/raw"))


def ingest_price_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    source = _write_with_bad_lines(
        feeds.raw_price_events(spark, sf_dir), f"{folder}/in", "json", BAD_PRICE_LINES
    )
    return _traced(raw.ingest_price_events(spark, source, f"{folder}/raw"))


def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per feed: rows, ingest instants, and rows that do not name an existing file of their own."""
    folder = shared_folder(spark)
    found = source_files(spark, sf_dir, folder)
    readers = {
        "orders": (raw.read_json_lines, schemas.RAW_ORDERS),
        "inventory": (raw.read_csv, schemas.RAW_INVENTORY),
        "price_events": (raw.read_json_lines, schemas.RAW_PRICE_EVENTS),
    }
    parts = []
    for feed, (reader, schema) in readers.items():
        rows = raw.add_provenance(reader(spark, found[feed], schema), found[feed], per_file=True)
        own_file = F.col(schemas.SOURCE_FILE).contains(f"/{feed}/")
        parts.append(
            rows.agg(
                F.lit(feed).alias("feed"),
                F.count(F.lit(1)).alias("rows"),
                F.countDistinct(schemas.INGESTED_AT).alias("ingest_instants"),
                F.count_if(~F.coalesce(own_file, F.lit(False))).alias("untraced_rows"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, parsed and corrupt rows per batch of source files, summed from the manifest of each feed's files.

    Every feed is delivered in three batches: one key's rows, all others, and lines that no reader can parse.
    """
    folder = shared_folder(spark)
    deliveries = {
        "orders": (feeds.raw_orders, "json", F.col("channel") == "BUILDING", BAD_ORDER_LINES, schemas.RAW_ORDERS),
        "inventory": (feeds.raw_inventory, "csv", F.col("warehouse") == "WH-1", BAD_INVENTORY_LINES, schemas.RAW_INVENTORY),
        "price_events": (feeds.raw_price_events, "json", F.col("source") == "click", BAD_PRICE_LINES, schemas.RAW_PRICE_EVENTS),
    }
    parts = []
    for feed, (source, kind, chosen, bad, schema) in deliveries.items():
        rows, one = source(spark, sf_dir), F.coalesce(chosen, F.lit(False))
        for batch, delivered in (("one", rows.filter(one)), ("others", rows.filter(~one))):
            writer = delivered.write.option("header", True).option("compression", DELIVERED)
            getattr(writer, kind)(f"{folder}/{feed}/{batch}")
        lines = (",".join(rows.columns), *bad) if kind == "csv" else bad
        spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(f"{folder}/{feed}/bad")
        read = (raw.read_csv if kind == "csv" else raw.read_json_lines)(spark, f"{folder}/{feed}/*", schema)
        parts.append(raw.file_manifest(read).withColumn("feed", F.lit(feed)))
    batch = F.regexp_extract("path", r"/([a-z]+)/[^/]+$", 1).alias("batch")
    return reduce(DataFrame.unionByName, parts).groupBy("feed", batch).agg(
        F.sum("rows").alias("rows"),
        F.sum("parsed_rows").alias("parsed_rows"),
        F.sum("corrupt_rows").alias("corrupt_rows"),
        F.sum("blank_rows").alias("blank_rows"),
        F.count_if((F.col("bytes") > 0) & F.col("modified_at").isNotNull()).cast("boolean").alias("sized"),
    )


def roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.overwrite(clean_orders(spark, sf_dir), f"{shared_folder(spark)}/orders")


def _route(feed: v.Feed, source: Query) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = shared_folder(spark)
        tables.overwrite(source(spark, sf_dir), f"{folder}/raw")
        good, bad = v.route(spark, feed, f"{folder}/raw", f"{folder}/routed")
        texts = {c: f"{c}_text" for c in feed.casts}
        return good.unionByName(bad.withColumnsRenamed(texts), allowMissingColumns=True)

    return query


def _run(spark: SparkSession, sf_dir: str) -> run.Layout:
    folder = shared_folder(spark)
    return run.run_all(spark, source_files(spark, sf_dir, f"{folder}/in"), f"{folder}/out")


def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table that a run from files writes."""
    done = _run(spark, sf_dir)
    found = {f"raw_{feed}": tables.read(spark, done.raw(feed)) for feed in run.FEEDS}
    found |= {f"clean_{feed}": run.clean_rows(spark, done, feed) for feed in run.FEEDS}
    found |= {f"quarantined_{feed}": run.quarantined_rows(spark, done, feed) for feed in run.FEEDS}
    found |= {name: tables.read(spark, done.metric(name)) for name in run.METRICS}
    counts = [
        table.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows")) for name, table in found.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run.totals(spark, _run(spark, sf_dir))


def acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acceptance_report(spark, _run(spark, sf_dir))


def acceptance_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over tables in which every criterion is broken, so that each count is put to the test."""
    orders = stored_orders(spark, sf_dir)
    stock, events = raw_inventory(spark, sf_dir), raw_price_events(spark, sf_dir)
    no_file = F.when(F.col("product_id").isNull(), F.lit(None)).otherwise(F.col(schemas.SOURCE_FILE))
    raw_tables = {
        "orders": orders.withColumn(schemas.SOURCE_FILE, no_file),
        "inventory": stock.filter(F.lit(False)),
        "price_events": events.withColumn(schemas.INGESTED_AT, F.lit(None).cast("string")),
    }
    no_reason = F.when(F.col(REASON).isin("INVALID_PRICE", "INVALID_OLD_PRICE"), F.lit(None)).otherwise(F.col(REASON))
    # The join that makes the orders, and the ranking of their copies, are done once: all parts read what is stored.
    rejected = {
        "orders": v.select_quarantined(v.label_stored(orders, v.ORDERS), v.ORDERS),
        "inventory": quarantine_inventory(spark, sf_dir),
        "price_events": quarantine_price_events(spark, sf_dir),
    }
    quarantined = {feed: rows.withColumn(REASON, no_reason) for feed, rows in rejected.items()}
    clean = tables.overwrite(v.clean(orders, v.ORDERS), f"{shared_folder(spark)}/orders")
    again = clean.filter("channel = 'BUILDING'").withColumn("quantity", -F.col("quantity"))
    unclassed = F.when(F.col("risk_level") != "HIGH", F.col("risk_level"))
    changes = metrics.price_change_ratio(F.col("old_price"), F.col("new_price"))
    measured = {
        "daily_revenue": metrics.daily_revenue(clean).filter(F.lit(False)),
        "inventory_risk": metrics.inventory_risk(clean, clean_inventory(spark, sf_dir)).withColumn("risk_level", unclassed),
        "price_anomalies": clean_price_events(spark, sf_dir).withColumn("price_change_ratio", changes),
    }
    return judge(raw_tables, quarantined, clean.unionByName(again), measured)


def export_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and one sum per metric table, read from the exported files."""
    folder = shared_folder(spark)
    sums = {
        "daily_revenue": (daily_revenue, "gross_revenue"),
        "inventory_risk": (inventory_risk, "current_quantity"),
        "price_anomalies": (price_anomalies, "new_price"),
    }
    stored = {name: f"{folder}/metrics/{name}" for name in sums}
    for name, (query, _) in sums.items():
        tables.overwrite(query(spark, sf_dir), stored[name])
    exported = serving.export_metrics(spark, stored, f"{folder}/export")
    parts = [
        tables.read(spark, exported[name]).agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.col(column).cast("double")).alias("total"),
        )
        for name, (_, column) in sums.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# Validation.


def cast_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = v.label_rows(raw_orders(spark, sf_dir), v.ORDERS)
    return labelled.select(
        "order_id",
        F.col("quantity").alias("quantity_text"),
        F.col("_typed_quantity").alias("quantity"),
        F.col("unit_price").alias("unit_price_text"),
        F.col("_typed_unit_price").alias("unit_price"),
    )


def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        v.label_rows(source(spark, sf_dir), feed).select(
            F.lit(feed.name).alias("feed"),
            F.col(column).alias("text"),
            F.col(f"_typed_{column}").alias("instant"),
        )
        for source, feed, column in (
            (raw_orders, v.ORDERS, "ordered_at"),
            (raw_inventory, v.INVENTORY, "updated_at"),
            (raw_price_events, v.PRICE_EVENTS, "changed_at"),
        )
    ]
    return reduce(DataFrame.unionByName, parts)


def label_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.label_rows(raw_orders(spark, sf_dir), v.ORDERS).select(*v.ORDERS.columns, REASON)


def dedupe_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row that passes the rules, and whether a later copy replaces it."""
    labelled = v.label_rows(tables.with_row_id(stored_orders(spark, sf_dir)), v.ORDERS)
    valid = labelled.filter(F.col(REASON).isNull())
    marked = mark_replaced(valid, v.ORDERS.unique_key, v.ORDERS.ranking(), F.lit(True), "superseded", tables.ROW_ID)
    return marked.select(*v.ORDERS.columns, "superseded")


def duplicate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine_orders(spark, sf_dir).filter(F.col(REASON) == schemas.DUPLICATE)


def negative_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_inventory(spark, sf_dir).filter("negative_stock = true")


# Metrics.


def daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.daily_revenue(clean_orders(spark, sf_dir))


def sales_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.sales_velocity(clean_orders(spark, sf_dir))


def current_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.current_stock(clean_inventory(spark, sf_dir))


def current_stock_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.current_stock(clean_inventory(spark, sf_dir), "latest")


def inventory_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.inventory_risk(clean_orders(spark, sf_dir), clean_inventory(spark, sf_dir))


def inventory_risk_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.inventory_risk(
        clean_orders(spark, sf_dir), clean_inventory(spark, sf_dir), stock_mode="latest"
    )


def price_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.price_anomalies(clean_price_events(spark, sf_dir))


def price_change_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = metrics.price_change_ratio(F.col("old_price"), F.col("new_price"))
    return clean_price_events(spark, sf_dir).select(
        "product_id", "old_price", "new_price", ratio.alias("price_change_ratio")
    )


def at_risk_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.at_risk_products(inventory_risk(spark, sf_dir))


def risk_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.risk_distribution(inventory_risk(spark, sf_dir))


def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two metrics need the clean orders, whose columns for them are therefore stored first."""
    needed = clean_orders(spark, sf_dir).select("product_id", "channel", "quantity", "unit_price", "ordered_at")
    orders = tables.overwrite(needed, f"{shared_folder(spark)}/orders")
    risk = metrics.inventory_risk(orders, clean_inventory(spark, sf_dir))
    return metrics.kpi_summary(metrics.daily_revenue(orders), risk, price_anomalies(spark, sf_dir))


def revenue_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.revenue_pivot(daily_revenue(spark, sf_dir), CHANNELS)


# Serving.


def serve_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.newest_revenue(daily_revenue(spark, sf_dir))


def revenue_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.revenue_by_day(daily_revenue(spark, sf_dir))


def serve_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a stored metric and of one that is not there yet."""
    folder = shared_folder(spark)
    tables.overwrite(daily_revenue(spark, sf_dir), f"{folder}/daily_revenue")
    counts = [
        serving.load_metric(spark, folder, name).agg(F.lit(name).alias("metric"), F.count(F.lit(1)).alias("rows"))
        for name in ("daily_revenue", "inventory_risk")
    ]
    return reduce(DataFrame.unionByName, counts)


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a preview of the clean orders has, next to all of them; which rows is not fixed."""
    orders = roundtrip(spark, sf_dir)
    parts = [serving.preview(orders, 10).agg(F.count(F.lit(1)).alias("rows")), orders.agg(F.count(F.lit(1)).alias("rows"))]
    return parts[0].withColumn("part", F.lit("preview")).unionByName(parts[1].withColumn("part", F.lit("all")))


def serve_inventory_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.risk_by_urgency(inventory_risk(spark, sf_dir))


def serve_price_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.largest_anomalies(price_anomalies(spark, sf_dir))


def risk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.risk_report(inventory_risk(spark, sf_dir))


def anomaly_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.anomaly_table(price_anomalies(spark, sf_dir))


def anomaly_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.anomaly_report(price_anomalies(spark, sf_dir))


# Quality.


def _label_totals(spark: SparkSession, sf_dir: str, feed: v.Feed, source: Query) -> DataFrame:
    return quality.label_totals(v.label_rows(source(spark, sf_dir), feed), feed.unique_key)


def quarantine_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per feed and reason, from counts per key: no row is marked for it."""
    parts = [
        _label_totals(spark, sf_dir, feed, source).filter(F.col(REASON).isNotNull()).withColumn("feed", F.lit(feed.name))
        for feed, source in ((v.ORDERS, raw_orders), (v.INVENTORY, raw_inventory), (v.PRICE_EVENTS, raw_price_events))
    ]
    return reduce(DataFrame.unionByName, parts)


def uniqueness_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.uniqueness(clean_orders(spark, sf_dir), ["order_id"])


def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reconcile_totals(_label_totals(spark, sf_dir, v.ORDERS, raw_orders))


def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(raw_orders(spark, sf_dir), v.ORDERS.columns)


def nonpositive_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.nonpositive_counts(cast_orders(spark, sf_dir), ["quantity", "unit_price"])


# Change log: the first batch lacks one channel; the second brings it, corrects another and repeats
# a third; the third corrects a fourth.


def _batches(orders: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = orders.select("order_id", "product_id", "channel", "quantity", "unit_price")
    more = F.col("quantity") + 1
    second = rows.filter(F.col("channel").isin("FURNITURE", "BUILDING", "MACHINERY"))
    return (
        rows.filter(~F.coalesce(F.col("channel") == "FURNITURE", F.lit(False))),
        second.withColumn("quantity", F.when(F.col("channel") == "BUILDING", more).otherwise(F.col("quantity"))),
        rows.filter(F.col("channel") == "HOUSEHOLD").withColumn("quantity", more + 1),
    )


def _logged(spark: SparkSession, sf_dir: str, order: tuple[int, ...]) -> str:
    """Write a change log of the batches numbered in ``order`` and return its path."""
    folder = shared_folder(spark)
    batches = _batches(tables.overwrite(clean_orders(spark, sf_dir), f"{folder}/orders"))
    for number in order:
        changelog.append(spark, batches[number], f"{folder}/log", ["order_id"], COMMITS[number])
    return f"{folder}/log"


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = tables.overwrite(clean_orders(spark, sf_dir), f"{shared_folder(spark)}/orders")
    first, second, _ = _batches(stored)
    return changelog.upsert(first, second, ["order_id"])


def upsert_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    log_path = _logged(spark, sf_dir, (0, 1, 1, 1))
    newest = changelog.latest_version(spark, log_path)
    rows = changelog.read_version(spark, log_path, newest)
    return rows.withColumn("version", F.lit(newest).cast("bigint"))


def as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = changelog.read_log(spark, _logged(spark, sf_dir, (0, 1, 2)))
    versions = [
        changelog.as_of(log, ["order_id"], number).withColumn("version", F.lit(number).cast("bigint"))
        for number in range(3)
    ]
    return reduce(DataFrame.unionByName, versions)


def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.newest_version(changelog.commits(spark, _logged(spark, sf_dir, (0, 1, 2))))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.table_history(spark, _logged(spark, sf_dir, (0, 1, 2))).withColumnsRenamed(
        {changelog.VERSION: "version", changelog.COMMITTED_AT: "committed_at"}
    )


def expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = changelog.read_log(spark, _logged(spark, sf_dir, (0, 1, 2)))
    return changelog.expire(log, ["order_id"], CUTOFF).withColumnsRenamed(
        {
            changelog.VERSION: "version",
            changelog.OPERATION: "operation",
            changelog.COMMITTED_AT: "committed_at",
        }
    )


def as_of_after_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version that retention leaves readable, read from the shortened log."""
    log_path = _logged(spark, sf_dir, (0, 1, 2))
    changelog.expire_log(spark, log_path, f"{log_path}-short", CUTOFF)
    oldest = changelog.oldest_complete(spark, f"{log_path}-short")
    versions = [
        changelog.read_version(spark, f"{log_path}-short", number).withColumn("version", F.lit(number).cast("bigint"))
        for number in range(oldest, changelog.latest_version(spark, f"{log_path}-short") + 1)
    ]
    return reduce(DataFrame.unionByName, versions)


def _optimized_then_upserted(zorder_by: list[str] | None) -> Query:
    """Two commits, a rewrite of the log, a third commit into the rewritten log, its newest state."""

    def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
        log_path = _logged(spark, sf_dir, (0, 1))
        layout.optimize_table(spark, log_path, f"{log_path}-new", zorder_by)
        orders = tables.read(spark, f"{log_path.rsplit('/', 1)[0]}/orders")
        changelog.append(spark, _batches(orders)[2], f"{log_path}-new", ["order_id"], COMMITS[2])
        return changelog.read_version(spark, f"{log_path}-new", 2)

    return run_query


def log_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the log exists, counted over its rows, and whether one that was never written does."""
    log_path = _logged(spark, sf_dir, (0,))
    written, unwritten = (changelog.commits(spark, path).agg((F.count(F.lit(1)) > 0).alias("there")) for path in (log_path, f"{log_path}-none"))
    rows = changelog.read_log(spark, log_path).agg(F.count(F.lit(1)).alias("rows"))
    return metrics.one_row(rows, written.withColumnRenamed("there", "written"), unwritten.withColumnRenamed("there", "unwritten"))


# Table layout.


def compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.compact(spark, f"{sf_dir}/lineitem.parquet", f"{shared_folder(spark)}/lineitem")


def cluster_by_z(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.cluster(
        spark, f"{sf_dir}/events.parquet", f"{shared_folder(spark)}/events", ["user_id", "ts"]
    )


def _without_zone(query: Query) -> Query:
    """Run in UTC and give instants as plain UTC timestamps."""

    def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = query(use_utc(spark), sf_dir)
        zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
        return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned}) if zoned else df

    return run_query


QUERIES: dict[str, Query] = {
    name: _without_zone(query)
    for name, query in {
        "ingest_orders": ingest_orders,
        "ingest_inventory": ingest_inventory,
        "ingest_price_events": ingest_price_events,
        "provenance": provenance,
        "file_manifest": file_manifest,
        "roundtrip": roundtrip,
        "route_orders": _route(v.ORDERS, raw_orders),
        "route_inventory": _route(v.INVENTORY, raw_inventory),
        "route_price_events": _route(v.PRICE_EVENTS, raw_price_events),
        "full_run": full_run,
        "run_totals": run_totals,
        "acceptance_report": acceptance,
        "acceptance_defects": acceptance_defects,
        "export_metrics": export_metrics,
        "cast_orders": cast_orders,
        "parse_timestamps": parse_timestamps,
        "label_orders": label_orders,
        "clean_orders": clean_orders,
        "quarantine_orders": quarantine_orders,
        "clean_inventory": clean_inventory,
        "quarantine_inventory": quarantine_inventory,
        "clean_price_events": clean_price_events,
        "quarantine_price_events": quarantine_price_events,
        "dedupe_orders": dedupe_orders,
        "duplicate_orders": duplicate_orders,
        "negative_stock": negative_stock,
        "daily_revenue": daily_revenue,
        "sales_velocity": sales_velocity,
        "current_stock": current_stock,
        "current_stock_latest": current_stock_latest,
        "inventory_risk": inventory_risk,
        "inventory_risk_latest": inventory_risk_latest,
        "price_change_ratio": price_change_ratio,
        "price_anomalies": price_anomalies,
        "at_risk_products": at_risk_products,
        "risk_distribution": risk_distribution,
        "kpi_summary": kpi_summary,
        "revenue_pivot": revenue_pivot,
        "serve_daily_revenue": serve_daily_revenue,
        "serve_inventory_risk": serve_inventory_risk,
        "serve_price_anomalies": serve_price_anomalies,
        "risk_report": risk_report,
        "anomaly_table": anomaly_table,
        "anomaly_report": anomaly_report,
        "quarantine_summary": quarantine_summary,
        "uniqueness_check": uniqueness_check,
        "reconciliation": reconciliation,
        "null_counts": null_counts,
        "nonpositive_counts": nonpositive_counts,
        "upsert": upsert,
        "upsert_replay": upsert_replay,
        "as_of": as_of,
        "as_of_after_expire": as_of_after_expire,
        "optimize_then_upsert": _optimized_then_upserted(None),
        "cluster_then_upsert": _optimized_then_upserted(["product_id", "quantity"]),
        "log_exists": log_exists,
        "revenue_by_day": revenue_by_day,
        "serve_missing": serve_missing,
        "preview_rows": preview_rows,
        "latest_version": latest_version,
        "history": history,
        "expire": expire,
        "compact": compact,
        "cluster_by_z": cluster_by_z,
    }.items()
}
