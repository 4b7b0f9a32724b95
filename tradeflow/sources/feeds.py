"""The three marketplace feeds derived from the given tables, with defects at fixed residues.

Orders are line items with the customer's market segment as channel, inventory is one snapshot per
part and supplier, price changes come from events. Every row of lineitem and events contributes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.sources import tables

WHOLE = "bigint"


def _digits(number: Column) -> Column:
    return number.cast(WHOLE).cast("string")


def _order_id() -> Column:
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    return F.when(key % 101 == 0, F.lit(None)).otherwise(
        F.concat(F.lit("ORD-"), key.cast("string"), F.lit("-"), line.cast("string"))
    )


def _product_id(number: Column) -> Column:
    return F.concat(F.lit("SKU-"), number.cast("string"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text. Orders and customers meet first, so line items are shuffled once.

    Both sides of the join with line items grow with the data, hence no broadcast.
    """
    items = tables.read(spark, f"{sf_dir}/lineitem.parquet")
    orders = tables.read(spark, f"{sf_dir}/orders.parquet")
    customers = tables.read(spark, f"{sf_dir}/customer.parquet")
    channels = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_mktsegment"
    )
    key = F.col("l_orderkey")
    quantity = (
        F.when(key % 97 == 3, F.lit("0"))
        .when(key % 97 == 4, F.lit("-3"))
        .when(key % 97 == 5, F.lit("abc"))
        .when(key % 97 == 6, F.lit(None))
        .otherwise(_digits(F.col("l_quantity")))
    )
    price = (
        F.when(key % 107 == 7, F.lit("0"))
        .when(key % 107 == 8, F.lit(None))
        .otherwise(_digits(F.floor(F.col("l_extendedprice") / F.col("l_quantity"))))
    )
    hour = F.lpad((key % 24).cast("string"), 2, "0")
    ordered_at = F.when(key % 109 == 9, F.lit("NOT-A-DATE")).otherwise(
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T"), hour, F.lit(":15:00Z"))
    )
    return items.join(channels.hint("merge"), key == F.col("o_orderkey")).select(
        _order_id().alias("order_id"),
        F.when(key % 103 == 1, F.lit(None)).otherwise(_product_id(F.col("l_partkey"))).alias("product_id"),
        F.when(key % 89 == 2, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("channel"),
        quantity.alias("quantity"),
        price.alias("unit_price"),
        ordered_at.alias("ordered_at"),
    )


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock snapshots as text; suppliers that do not stock a part report none of it."""
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    newest = (
        tables.read(spark, f"{sf_dir}/lineitem.parquet")
        .groupBy("l_partkey", "l_suppkey")
        .agg(F.max("l_shipdate").alias("newest"))
    )
    units = F.when(supplier % (part % 4 + 1) == 0, (part * 31 + supplier * 17) % 23 - 3).otherwise(0)
    updated_at = F.when((part + supplier) % 59 == 2, F.lit("BAD-TIMESTAMP")).otherwise(
        F.concat(F.date_format("newest", "yyyy-MM-dd"), F.lit("T00:00:00Z"))
    )
    return newest.select(
        F.when(part % 41 == 0, F.lit(None)).otherwise(_product_id(part)).alias("product_id"),
        F.when((part + supplier) % 53 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("WH-"), (supplier % 5).cast("string")))
        .alias("warehouse"),
        _digits(units).alias("quantity"),
        updated_at.alias("updated_at"),
    )


def raw_price_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    cents = F.round(F.col("value") * 100).cast(WHOLE)
    old = F.when(event % 47 == 1, F.lit("0")).otherwise(_digits(cents))
    new = F.when(event % 61 == 2, F.lit(None)).otherwise(
        _digits(F.floor(cents * (event % 71 + 70) / 100))
    )
    changed_at = F.when(event % 67 == 3, F.lit("INVALID")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    return tables.read(spark, f"{sf_dir}/events.parquet").select(
        F.when(event % 43 == 0, F.lit(None)).otherwise(_product_id(F.col("user_id"))).alias("product_id"),
        old.alias("old_price"),
        new.alias("new_price"),
        changed_at.alias("changed_at"),
        F.col("event_type").alias("source"),
    )
