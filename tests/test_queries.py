"""Every registered query against its SQL, and the figures of a whole run."""

import json

import pytest
from frames import SF_DIR
from oracle_check import compare, connect

import __spark_entry__ as driver
from tradeflow.plans import run
from tradeflow.plans.acceptance import acceptance_report
from tradeflow.plans.registry import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(NAMES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, con, name):
    assert compare(driver.queries()[name](spark, SF_DIR), con, driver.oracle_sql()[name]) == ""


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() == 195


def test_run_on_small_files(spark, folder):
    orders = [
        dict(order_id="o1", product_id="p", channel="web", quantity=2, unit_price=10, ordered_at="2026-07-01T10:00:00Z"),
        dict(order_id="o1", product_id="p", channel="web", quantity=3, unit_price=10, ordered_at="2026-07-01T11:00:00Z"),
        dict(order_id=None, product_id="p", channel="web", quantity=3, unit_price=10, ordered_at="2026-07-01T11:00:00Z"),
    ]
    prices = [dict(product_id="p", old_price=100, new_price=130, changed_at="2026-07-01T00:00:00Z", source="s")]
    with open(f"{folder}/orders.jsonl", "w") as file:
        file.writelines(json.dumps(o) + "\n" for o in orders)
    with open(f"{folder}/prices.jsonl", "w") as file:
        file.writelines(json.dumps(p) + "\n" for p in prices)
    with open(f"{folder}/stock.csv", "w") as file:
        file.write("product_id,warehouse,quantity,updated_at\np,w,-6,2026-07-01T00:00:00Z\n")
    sources = dict(
        orders=f"{folder}/orders.jsonl", inventory=f"{folder}/stock.csv", price_events=f"{folder}/prices.jsonl"
    )
    done = run.run_all(spark, sources, f"{folder}/out")
    totals = run.totals(spark, done).first().asDict()
    assert totals == dict(
        raw_orders=3, quarantined_orders=2, raw_inventory=1, quarantined_inventory=0, raw_price_events=1,
        quarantined_price_events=0, clean_orders=1, clean_inventory=1, negative_stock=1, clean_price_events=1,
        revenue_groups=1, total_revenue=30.0, stocked_products=1, critical_products=1, high_products=0,
        price_anomalies=1,
    )
    report = acceptance_report(spark, done).collect()
    assert len(report) == 8 and all(r.passed for r in report)
