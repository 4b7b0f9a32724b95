"""One key, or one group of equal copies, holding a third of all rows."""

import re

import pytest
from frames import ORDER, plan, raw, rows
from pyspark.sql import functions as F

from tradeflow.operators.latest import latest_per_key, mark_superseded
from tradeflow.plans import validation as v
from tradeflow.sources.schemas import REASON


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows in 8 partitions: 1,000 of one order, of them 500 equal; 500 without id; 1,500 unique."""
    base = raw(spark, ORDER).drop("order_id", "quantity")
    n = F.col("n")
    order_id = F.when(n % 3 == 0, "hot").when(n % 6 == 1, F.lit(None)).otherwise(F.concat(F.lit("o"), n))
    quantity = F.when(n % 2 == 0, F.lit("1")).otherwise((n % 7 + 1).cast("string"))
    numbers = spark.range(0, 3000, 1, 8).toDF("n")
    columns = [F.lit(base.first()[c]).alias(c) for c in base.columns]
    return numbers.select(order_id.alias("order_id"), quantity.alias("quantity"), *columns)


def test_no_keys_at_all(spark):
    keyless = spark.range(100).select("id", F.lit(None).cast("string").alias("k"))
    for table in (keyless, keyless.limit(0)):
        marked = mark_superseded(table, ["k"], [F.desc("id")], F.col("k").isNotNull(), "old")
        assert marked.filter("old").count() == 0 and marked.count() == table.count()


def test_several_key_columns(spark):
    pairs = spark.range(100).selectExpr("'a' AS k", "id % 2 AS l", "id AS n")
    marked = mark_superseded(pairs, ["k", "l"], [F.desc("n")], F.lit(True), "old")
    assert rows(marked.filter("NOT old"), "l", "n") == [(0, 98), (1, 99)]


def test_labelling_agrees_with_brute_force(spark, skewed):
    labelled = v.label(skewed, v.ORDERS)
    counts = {r[REASON]: r["n"] for r in labelled.groupBy(REASON).agg(F.count("*").alias("n")).collect()}
    assert counts == {None: 1501, "MISSING_ORDER_ID": 500, "DUPLICATE_ORDER": 999}
    everything = ["order_id", "quantity", "ordered_at"]
    assert rows(labelled, *everything) == rows(skewed, *everything)
    best = max(r.quantity for r in skewed.filter("order_id = 'hot'").collect())
    winner = labelled.filter(f"order_id = 'hot' AND {REASON} IS NULL")
    assert rows(winner, "quantity") == [(best,)]


def test_no_window_group_holds_the_hot_rows(spark, skewed):
    """Every window is also partitioned by the source partition, directly or but for the best rows."""
    marked = mark_superseded(skewed, ["order_id"], [F.desc("quantity")], F.lit(True), "old")
    windows = re.findall(r"Window \[row_number\(\) windowspecdefinition\(([^]]*)", plan(marked))
    assert windows and all("_slot" in w or "_stage" in w for w in windows)


def test_marking_reads_its_input_once(spark, skewed, folder):
    skewed.write.parquet(f"{folder}/in")
    bad = v.quarantined(spark.read.parquet(f"{folder}/in"), v.ORDERS)
    physical = plan(bad).split("== Physical Plan ==")[1]
    assert physical.count("FileScan") == 1 and "Join" not in physical


def test_latest_per_key_is_cut_before_the_shuffle(spark, skewed):
    latest = latest_per_key(skewed, ["order_id"], [F.desc("quantity")])
    physical = plan(latest).split("== Physical Plan ==")[1]
    exchange = physical.index("Exchange")
    assert "WindowGroupLimit" in physical[:exchange] and "WindowGroupLimit" in physical[exchange:]


def test_clean_orders_evaluates_conversions_once(spark, skewed):
    physical = plan(v.clean(skewed, v.ORDERS)).split("== Physical Plan ==")[1]
    assert physical.count("try_cast(unit_price") + physical.count("try_cast(100 as double)") <= 1
