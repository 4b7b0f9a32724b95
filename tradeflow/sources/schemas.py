"""Declared schemas. Raw business columns are all text, so that no source value is lost on read."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

INGESTED_AT = "_ingested_at"
SOURCE_FILE = "_source_file"
PROVENANCE = (INGESTED_AT, SOURCE_FILE)
CORRUPT = "_corrupt_record"
REASON = "_quarantine_reason"
DUPLICATE = "DUPLICATE_ORDER"
STATUS, CLEAN, QUARANTINED = "_status", "clean", "quarantined"


def _text(*names: str) -> StructType:
    return StructType([StructField(name, StringType(), True) for name in names])


RAW_ORDERS = _text(
    "order_id", "product_id", "channel", "quantity", "unit_price", "ordered_at", "extra_field"
)
RAW_INVENTORY = _text("product_id", "warehouse", "quantity", "updated_at")
RAW_PRICE_EVENTS = _text("product_id", "old_price", "new_price", "changed_at", "source")

DAILY_REVENUE = StructType(
    [
        StructField("date", DateType()),
        StructField("channel", StringType()),
        StructField("order_count", LongType()),
        StructField("units_sold", LongType()),
        StructField("gross_revenue", DoubleType()),
    ]
)
INVENTORY_RISK = StructType(
    [
        StructField("product_id", StringType()),
        StructField("current_quantity", LongType()),
        StructField("avg_daily_sales", DoubleType()),
        StructField("days_of_stock", DoubleType()),
        StructField("risk_level", StringType()),
    ]
)
PRICE_ANOMALIES = StructType(
    [
        StructField("product_id", StringType()),
        StructField("old_price", DoubleType()),
        StructField("new_price", DoubleType()),
        StructField("price_change_ratio", DoubleType()),
        StructField("changed_at", TimestampType()),
        StructField("source", StringType()),
    ]
)
