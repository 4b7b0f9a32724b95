"""Small raw frames with one good default row each."""

from tradeflow.sources.schemas import PROVENANCE

SF_DIR = "/root/testdata/sf0.001"
STAMP = ("2026-07-01T00:00:00Z", "feed.jsonl")

ORDER = dict(
    order_id="o1", product_id="p1", channel="web", quantity="2", unit_price="100", ordered_at="2026-07-01T10:00:00Z"
)
STOCK = dict(product_id="p1", warehouse="w1", quantity="10", updated_at="2026-07-01T10:00:00Z")
PRICE = dict(product_id="p1", old_price="100", new_price="120", changed_at="2026-07-01T10:00:00Z", source="s")


def raw(spark, default, *overrides):
    columns = [*default, *PROVENANCE]
    stamp = dict(zip(PROVENANCE, STAMP))
    rows = [tuple({**default, **stamp, **row}[c] for c in columns) for row in (overrides or ({},))]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def clean_orders(spark, *rows):
    """Rows of (order_id, product_id, channel, quantity, unit_price, ordered_at text)."""
    df = spark.createDataFrame(
        list(rows), "order_id string, product_id string, channel string, quantity long, unit_price double, t string"
    )
    return df.selectExpr("order_id", "product_id", "channel", "quantity", "unit_price", "timestamp(t) ordered_at")


def clean_stock(spark, *rows):
    """Rows of (product_id, warehouse, quantity, updated_at text)."""
    df = spark.createDataFrame(list(rows), "product_id string, warehouse string, quantity long, t string")
    return df.selectExpr("product_id", "warehouse", "quantity", "timestamp(t) updated_at")


def clean_prices(spark, *rows):
    """Rows of (product_id, old_price, new_price)."""
    df = spark.createDataFrame(list(rows), "product_id string, old_price double, new_price double")
    return df.selectExpr("*", "timestamp('2026-07-01 10:00:00') changed_at", "'s' source")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().toString()
