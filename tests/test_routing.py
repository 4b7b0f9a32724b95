"""Stored rows with an identity: marking without windows, one labelled pass, counts without marking."""

import random
import re

import pytest
from frames import ORDER, PRICE, STOCK, plan, raw, rows
from pyspark.sql import functions as F

from tradeflow.operators import quality
from tradeflow.operators.latest import mark_replaced
from tradeflow.plans import acceptance
from tradeflow.plans import validation as v
from tradeflow.sources import tables
from tradeflow.sources.schemas import DUPLICATE, PROVENANCE, REASON


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """3,000 orders in 8 files: 1,000 rows of one id, of them 500 equal; 500 without id; 1,500 unique."""
    base, n = raw(spark, ORDER).drop("order_id", "quantity"), F.col("n")
    order_id = F.when(n % 3 == 0, "hot").when(n % 6 == 1, F.lit(None)).otherwise(F.concat(F.lit("o"), n))
    quantity = F.when(n % 2 == 0, F.lit("1")).otherwise((n % 7 + 1).cast("string"))
    columns = [F.lit(base.first()[c]).alias(c) for c in base.columns]
    path = str(tmp_path_factory.mktemp("raw"))
    spark.range(0, 3000, 1, 8).toDF("n").select(order_id.alias("order_id"), quantity.alias("quantity"), *columns).write.mode("overwrite").parquet(path)
    return path


def test_labels_of_stored_rows_equal_those_of_frames(spark, stored):
    table = tables.read(spark, stored)
    columns = ["order_id", "quantity", "ordered_at", REASON]
    assert rows(v.label_stored(table, v.ORDERS), *columns) == rows(v.label(table, v.ORDERS), *columns)


def test_marking_has_no_window_and_joins_on_the_identity(spark, stored):
    physical = plan(v.label_stored(tables.read(spark, stored), v.ORDERS)).split("== Physical Plan ==")[1]
    assert "Window" not in physical and physical.count("Join") == 1
    assert "partial_max" in physical or re.search(r"functions=\[max\(.*functions=\[max\(", physical, re.S)
    assert re.search(rf"Join \[{tables.ROW_ID[0]}#\d+L?, {tables.ROW_ID[1]}#", physical)


def test_marking_agrees_with_brute_force(spark, folder):
    draw = random.Random(3)
    made = [(draw.choice(["a", "b", None]), draw.choice([1, 2]), draw.choice([None, 1, 2, 3]), draw.choice(["x", "y", None]), k) for k in range(300)]
    spark.createDataFrame(made, "k string, l int, at int, s string, n int").repartition(5).write.parquet(folder + "/t")
    table = tables.with_row_id(spark.read.parquet(folder + "/t"))
    marked = mark_replaced(table, ["k", "l"], [F.col("at"), F.col("s")], F.col("n") % 5 > 0, "old", tables.ROW_ID)
    got = marked.collect()
    assert sorted(r.n for r in got) == list(range(300))
    rank = lambda r: (r.at is not None, r.at or 0, r.s is not None, r.s or "")
    for key in {(r.k, r.l) for r in got}:
        own = [r for r in got if (r.k, r.l) == key]
        kept = [r for r in own if r.n % 5 and not r.old]
        assert len(kept) == 1 and rank(kept[0]) == max(rank(r) for r in own if r.n % 5)
    assert not any(r.old for r in got if r.n % 5 == 0)


def test_a_routed_table_is_one_pass_and_two_folders(spark, stored, folder):
    good, bad = v.route(spark, v.ORDERS, stored, f"{folder}/routed")
    assert good.columns == [*v.ORDERS.columns, *PROVENANCE] and bad.columns == [*v.ORDERS.columns, *PROVENANCE, REASON]
    frame = tables.read(spark, stored)
    assert rows(good) == rows(v.clean(frame, v.ORDERS)) and rows(bad) == rows(v.quarantined(frame, v.ORDERS))
    assert "PartitionFilters: [isnotnull(_status" in plan(good) and dict(good.dtypes)["quantity"] == "bigint"


@pytest.mark.parametrize("feed,default", [(v.ORDERS, ORDER), (v.INVENTORY, STOCK), (v.PRICE_EVENTS, PRICE)])
def test_routes_without_rows_of_a_status(spark, folder, feed, default):
    for name, frame, want in (("one", raw(spark, default), (1, 0)), ("none", raw(spark, default).limit(0), (0, 0))):
        frame.write.parquet(f"{folder}/{name}")
        good, bad = v.route(spark, feed, f"{folder}/{name}", f"{folder}/{name}-routed")
        assert (good.count(), bad.count()) == want


def test_totals_equal_counted_labels(spark, stored):
    table = tables.read(spark, stored)
    totals = quality.label_totals(v.label_rows(table, v.ORDERS), v.ORDERS.unique_key)
    labelled = v.label(table, v.ORDERS)
    assert rows(totals) == rows(labelled.groupBy(REASON).agg(F.count("*").alias("rows")))
    assert rows(quality.reconcile_totals(totals)) == rows(quality.reconciliation(labelled)) == [(3000, 1501, 1499, 999, True)]
    physical = plan(totals).split("== Physical Plan ==")[1]
    assert "Window" not in physical and "unit_price" not in physical[: physical.rindex("Exchange")].split("Exchange")[0]


def test_totals_of_feeds_without_key_and_of_nothing(spark):
    frame = raw(spark, STOCK, dict(), dict(), dict(warehouse=None))
    assert rows(quality.label_totals(v.label_rows(frame, v.INVENTORY), ())) == [("MISSING_WAREHOUSE", 1), (None, 2)]
    empty = quality.label_totals(v.label_rows(raw(spark, ORDER).limit(0), v.ORDERS), v.ORDERS.unique_key)
    assert empty.count() == 0 and rows(quality.reconcile_totals(empty)) == [(0, 0, 0, 0, True)]


def test_every_broken_criterion_is_counted(spark):
    orders = spark.createDataFrame([("o", 1), ("o", 0), (None, 2)], "order_id string, quantity long")
    one = spark.createDataFrame([(None, "f")], ", ".join(f"{c} string" for c in PROVENANCE))
    bad = spark.createDataFrame([(None,), (DUPLICATE,)], f"{REASON} string")
    metric = {
        "daily_revenue": spark.range(0),
        "inventory_risk": spark.createDataFrame([(None,), ("HIGH",)], "risk_level string"),
        "price_anomalies": spark.createDataFrame([(10.0, 13.0), (10.0, 11.0)], "old_price double, new_price double"),
    }
    report = {r.criterion[0]: (r.observed, r.passed) for r in acceptance.judge({"a": one, "b": one.limit(0)}, {"a": bad}, orders, metric).collect()}
    assert report == {"1": (1, False), "2": (1, False), "3": (2, False), "4": (1, False), "5": (1, False), "6": (1, False), "7": (1, False), "8": (1, False)}


@pytest.mark.parametrize("files", [("f",), ("f", "g", None)], ids=["one source", "several"])
def test_provenance_of_one_value_is_not_shuffled(spark, folder, files):
    """Copies that tie in all but their source: the greatest source stays, and a single one is left out of all shuffles."""
    given = [dict(order_id=k, _source_file=f) for k in ("a", "a", "b") for f in files]
    raw(spark, ORDER, *given).repartition(3).write.parquet(folder + "/t")
    table = tables.read(spark, folder + "/t")
    labelled = v.label_stored(table, v.ORDERS)
    columns = ["order_id", *PROVENANCE, REASON]
    assert rows(labelled, *columns) == rows(v.label(table, v.ORDERS), *columns)
    assert set(tables.single_values(table, PROVENANCE)) == {PROVENANCE[0], *PROVENANCE[: 2 if len(files) == 1 else 1]}
    scans = [line for line in plan(labelled).split("== Physical Plan ==")[1].splitlines() if "FileScan" in line]
    assert scans and all((PROVENANCE[1] in line) == (len(files) > 1) and PROVENANCE[0] not in line for line in scans)


def test_a_table_without_rows_has_single_values(spark, folder):
    raw(spark, ORDER).limit(0).write.parquet(folder + "/t")
    assert v.label_stored(tables.read(spark, folder + "/t"), v.ORDERS).count() == 0


def test_source_files_are_compressed(spark, folder):
    import glob

    from tradeflow.plans import registry

    feed = raw(spark, ORDER, dict(order_id="a"), dict(order_id="b")).drop(*PROVENANCE)
    for kind in ("json", "csv"):
        registry._write_with_bad_lines(feed, f"{folder}/{kind}", kind, ("bad",))
        found = glob.glob(f"{folder}/{kind}/good/part-*")
        assert found and all(name.endswith(".gz") for name in found)


def test_defects_make_and_store_the_orders_once(spark, monkeypatch):
    from frames import SF_DIR

    from tradeflow.plans import registry

    made, source = [], registry.feeds.raw_orders
    monkeypatch.setattr(registry.feeds, "raw_orders", lambda *a: made.append(a) or source(*a))
    registry.acceptance_defects(spark, SF_DIR)
    assert len(made) == 1
