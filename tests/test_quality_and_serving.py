import random

import pytest
from frames import clean_orders, clean_prices, clean_stock, plan, rows
from pyspark.sql import functions as F

from tradeflow.functions.display import one_decimal, signed_percent
from tradeflow.operators import quality as q
from tradeflow.plans import metrics as m
from tradeflow.plans import serving as s
from tradeflow.sources.schemas import INVENTORY_RISK, REASON


def test_quarantine_summary(spark):
    df = spark.createDataFrame([("A",), ("A",), ("B",)], f"{REASON} string")
    assert q.quarantine_summary(df) == {"A": 2, "B": 1}
    assert q.quarantine_summary(df.limit(0)) == {}


def test_assertions(spark):
    df = spark.createDataFrame([(1, None), (2, 0.0), (3, -1.0)], "a int, b double")
    q.assert_no_nulls(df, "a")
    q.assert_all_positive(df, "a")
    with pytest.raises(AssertionError, match="'b' has 1 null"):
        q.assert_no_nulls(df, "a", "b")
    with pytest.raises(AssertionError, match="'b' has 2 non-positive"):
        q.assert_all_positive(df, "a", "b")
    q.assert_all_positive(df.filter("b IS NULL"), "b")


def test_uniqueness(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert rows(q.uniqueness(df, ["k"])) == [(3, 2, False)]
    assert rows(q.uniqueness(df.distinct(), ["k"])) == [(2, 2, True)]
    assert rows(q.uniqueness(df.limit(0), ["k"])) == [(0, 0, True)]


def test_reconciliation(spark):
    df = spark.createDataFrame([(None,), ("DUPLICATE_ORDER",), ("INVALID_PRICE",)], f"{REASON} string")
    assert rows(q.reconciliation(df)) == [(3, 1, 2, 1, True)]


def test_one_decimal_prints_as_python_does(spark):
    random.seed(1)
    values = [0.0, 0.05, 0.15, 0.25, 0.35, 0.75, 2.5, 1.05, -0.25, -0.35, 9.95, 99.95, 0.45, 123456.05, 1e12 + 0.25]
    values += [random.uniform(-1000, 1000) for _ in range(3000)]
    values += [round(random.uniform(0, 50), 2) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    out = df.select("v", one_decimal(F.col("v")).alias("t"), signed_percent(F.col("v")).alias("p")).collect()
    assert [r.t for r in out] == [f"{r.v:.1f}" for r in out]
    assert [r.p for r in out] == [f"{r.v * 100:+.1f}%" for r in out]


def test_risk_report(spark):
    risk = spark.createDataFrame(
        [("a", 5, 2.0, 2.5, "CRITICAL"), ("b", 5, None, None, "NORMAL"), ("c", 1, 0.25, 4.0, "HIGH")], INVENTORY_RISK
    )
    assert rows(s.risk_report(risk)) == [
        ("a", 5, "2.0", "2.5", "🔴 CRITICAL"),
        ("b", 5, "—", "N/A (no sales)", "🟢 NORMAL"),
        ("c", 1, "0.2", "4.0", "🟠 HIGH"),
    ]


def test_anomaly_reports(spark):
    found = m.price_anomalies(clean_prices(spark, ("a", 1000.4, 1500.5), ("b", 3.0, 1.0)))
    assert rows(s.anomaly_table(found)) == [
        ("a", 1000.4, 1500.5, "2026-07-01 10:00", "s", "+50.0%"),
        ("b", 3.0, 1.0, "2026-07-01 10:00", "s", "-66.7%"),
    ]
    assert rows(s.anomaly_report(found), "product_id", "old_price", "new_price", "change_pct") == [
        ("a", 1000.0, 1501.0, 50.0),
        ("b", 3.0, 1.0, -66.7),
    ]


def test_ordered_reads(spark):
    risk = spark.createDataFrame(
        [("b", 1, 1.0, None, "NORMAL"), ("a", 1, 1.0, None, "NORMAL"), ("c", 1, 1.0, 2.0, "HIGH")], INVENTORY_RISK
    )
    assert [r.product_id for r in s.risk_by_urgency(risk).collect()] == ["c", "a", "b"]
    orders = clean_orders(
        spark,
        *[(str(d), "p", c, 1, 1.0, f"2026-07-0{d}") for d in (1, 2) for c in ("web", "app", None)],
    )
    revenue = m.daily_revenue(orders)
    assert [r.channel for r in s.newest_revenue(revenue, 4).collect()] == [None, "app", "web", None]
    assert [r.channel for r in s.revenue_by_day(revenue).collect()] == [None, "app", "web"] * 2


def test_top_k_breaks_ties_by_content(spark):
    found = m.price_anomalies(clean_prices(spark, *[(f"p{i}", 1.0, 2.0) for i in range(5)], ("big", 1.0, 9.0)))
    top = s.largest_anomalies(found.repartition(3), 3)
    assert [r.product_id for r in top.collect()] == ["big", "p0", "p1"]
    assert "TakeOrderedAndProject" in plan(top)


def test_preview(spark):
    assert s.preview(spark.range(100)).count() == 5 and s.preview(spark.range(2), 10).count() == 2


def test_missing_metric_is_empty(spark, folder):
    table = s.load_metric(spark, folder, "inventory_risk")
    assert table.schema == INVENTORY_RISK and table.isEmpty()


def test_export_writes_one_file_while_small(spark, folder):
    stock = clean_stock(spark, ("p", "w", 5, "2026-07-01"))
    stock.repartition(4).write.parquet(f"{folder}/t")
    written = s.export_metrics(spark, {"t": f"{folder}/t"}, f"{folder}/export")
    import glob

    assert len(glob.glob(f"{written['t']}/*.parquet")) == 1
    assert rows(spark.read.parquet(written["t"])) == rows(stock)


def test_one_decimal_of_large_values(spark, ansi):
    from tradeflow.functions.display import one_decimal

    values = [0.25, -0.35, 2.0**53, 5e17, -1e18, 2.0**62, 1e19, 1e37]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(one_decimal(F.col("v")))
    assert [r[0] for r in df.collect()] == [f"{v:.1f}" for v in values[:-2]] + ["10000000000000000000.0", "1" + "0" * 37 + ".0"]
    huge = spark.createDataFrame([(1e300,)], "v double").select(one_decimal(F.col("v"))).first()[0]
    assert float(huge) == 1e300


def test_export_reads_a_table_once_and_bounds_its_files(spark, folder, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    spark.range(1000).selectExpr("id", "id % 7 AS k").repartition(6).write.parquet(f"{folder}/t")
    read, times = s.tables.read, []
    monkeypatch.setattr(s.tables, "read", lambda *a: (times.append(a[1]), read(*a))[1])
    written = s.export_metrics(spark, {"t": f"{folder}/t"}, f"{folder}/export", rows_per_file=300)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{written['t']}/*.parquet")]
    assert times == [f"{folder}/t"] and sum(sizes) == 1000 and max(sizes) <= 300
    assert rows(spark.read.parquet(written["t"])) == rows(spark.read.parquet(f"{folder}/t"))
