"""The whole batch: raw files to raw, clean and quarantine tables, then metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.plans import metrics
from tradeflow.plans import validation as v
from tradeflow.sources import raw, tables

FEEDS = ("orders", "inventory", "price_events")
METRICS = ("daily_revenue", "inventory_risk", "price_anomalies")


@dataclass(frozen=True)
class Layout:
    """Where each table of a run lives below one base folder."""

    base: str

    def raw(self, feed: str) -> str:
        return f"{self.base}/raw/{feed}"

    def routed(self, feed: str) -> str:
        return f"{self.base}/routed/{feed}"

    def metric(self, name: str) -> str:
        return f"{self.base}/metrics/{name}"


def ingest(spark: SparkSession, sources: dict[str, str], layout: Layout) -> None:
    raw.ingest_orders(spark, sources["orders"], layout.raw("orders"))
    raw.ingest_inventory(spark, sources["inventory"], layout.raw("inventory"))
    raw.ingest_price_events(spark, sources["price_events"], layout.raw("price_events"))


def validate(spark: SparkSession, layout: Layout) -> None:
    for feed in FEEDS:
        v.route(spark, v.FEEDS[feed], layout.raw(feed), layout.routed(feed))


def clean_rows(spark: SparkSession, layout: Layout, feed: str) -> DataFrame:
    return v.read_routed(spark, v.FEEDS[feed], layout.routed(feed))[0]


def quarantined_rows(spark: SparkSession, layout: Layout, feed: str) -> DataFrame:
    return v.read_routed(spark, v.FEEDS[feed], layout.routed(feed))[1]


def build_metrics(spark: SparkSession, layout: Layout) -> None:
    orders, inventory, events = (clean_rows(spark, layout, feed) for feed in FEEDS)
    tables.overwrite(metrics.daily_revenue(orders), layout.metric("daily_revenue"))
    tables.overwrite(metrics.inventory_risk(orders, inventory), layout.metric("inventory_risk"))
    tables.overwrite(metrics.price_anomalies(events), layout.metric("price_anomalies"))


def run_all(spark: SparkSession, sources: dict[str, str], base: str) -> Layout:
    """Ingest, validate, build metrics; each step reads what the step before has stored."""
    layout = Layout(base)
    ingest(spark, sources, layout)
    validate(spark, layout)
    build_metrics(spark, layout)
    return layout


def totals(spark: SparkSession, layout: Layout) -> DataFrame:
    """One row of row counts and sums over the stored tables of a run."""
    rows = F.count(F.lit(1))
    parts = []
    for feed in FEEDS:
        parts += [
            tables.read(spark, layout.raw(feed)).agg(rows.alias(f"raw_{feed}")),
            quarantined_rows(spark, layout, feed).agg(rows.alias(f"quarantined_{feed}")),
        ]
    clean = {feed: clean_rows(spark, layout, feed) for feed in FEEDS}
    stocked = clean["inventory"]
    risk = tables.read(spark, layout.metric("inventory_risk"))
    revenue = tables.read(spark, layout.metric("daily_revenue"))
    anomalies = tables.read(spark, layout.metric("price_anomalies"))
    parts += [
        clean["orders"].agg(rows.alias("clean_orders")),
        stocked.agg(
            rows.alias("clean_inventory"), F.count_if("negative_stock").alias("negative_stock")
        ),
        clean["price_events"].agg(rows.alias("clean_price_events")),
        revenue.agg(
            rows.alias("revenue_groups"),
            F.coalesce(F.sum("gross_revenue"), F.lit(0.0)).alias("total_revenue"),
        ),
        risk.agg(
            rows.alias("stocked_products"),
            F.count_if(F.col("risk_level") == "CRITICAL").alias("critical_products"),
            F.count_if(F.col("risk_level") == "HIGH").alias("high_products"),
        ),
        anomalies.agg(rows.alias("price_anomalies")),
    ]
    return metrics.one_row(*parts)
