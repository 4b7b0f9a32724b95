"""The eight acceptance criteria of a run as one table; each counts violations, so 0 is expected."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.plans import run
from tradeflow.plans.metrics import ANOMALY_THRESHOLD, is_price_anomaly
from tradeflow.plans.run import FEEDS, METRICS, Layout
from tradeflow.sources import tables
from tradeflow.sources.schemas import PROVENANCE, REASON

INGESTED = "1 all feeds are ingested"
TRACEABLE = "2 raw rows are traceable"
VALID = "3 clean orders hold no invalid rows"
REASONED = "4 quarantined rows have a reason"
ONCE = "5 orders are counted once"
CLASSED = "6 every stocked product has a risk class"
LARGE = "7 anomalies reach the threshold"
FILLED = "8 metric tables hold rows"


def acceptance_report(spark: SparkSession, layout: Layout, threshold: float = ANOMALY_THRESHOLD) -> DataFrame:
    """Columns criterion, observed, expected, passed, over the stored tables of a run."""
    return judge(
        {feed: tables.read(spark, layout.raw(feed)) for feed in FEEDS},
        {feed: run.quarantined_rows(spark, layout, feed) for feed in FEEDS},
        run.clean_rows(spark, layout, "orders"),
        {name: tables.read(spark, layout.metric(name)) for name in METRICS},
        threshold,
    )


def judge(
    raw: Mapping[str, DataFrame],
    quarantined: Mapping[str, DataFrame],
    orders: DataFrame,
    metric: Mapping[str, DataFrame],
    threshold: float = ANOMALY_THRESHOLD,
) -> DataFrame:
    """The report over given tables. Each is read once: all its criteria are counted in one pass."""
    untraceable = F.greatest(*[F.col(c).isNull().cast("int") for c in PROVENANCE]) == 1
    invalid = F.col("order_id").isNull() | F.coalesce(F.col("quantity") <= 0, F.lit(True))
    small = ~is_price_anomaly(F.col("old_price"), F.col("new_price"), threshold)
    per_order = orders.groupBy("order_id").agg(F.count(F.lit(1)).alias("_rows"), F.count_if(invalid).alias("_invalid"))
    empty = (F.count(F.lit(1)) == 0).cast("bigint")
    counted = [
        *[_counts(t, {INGESTED: empty, TRACEABLE: F.count_if(untraceable)}) for t in raw.values()],
        *[_counts(t, {REASONED: F.count_if(F.col(REASON).isNull())}) for t in quarantined.values()],
        _counts(per_order, {VALID: _sum("_invalid"), ONCE: _sum("_rows") - F.count(F.lit(1))}),
        _counts(metric["daily_revenue"], {FILLED: empty}),
        _counts(metric["inventory_risk"], {FILLED: empty, CLASSED: F.count_if(F.col("risk_level").isNull())}),
        _counts(metric["price_anomalies"], {FILLED: empty, LARGE: F.count_if(small)}),
    ]
    return reduce(DataFrame.unionByName, counted).groupBy("criterion").agg(F.sum("observed").alias("observed")).select(
        "criterion",
        "observed",
        F.lit(0).cast("bigint").alias("expected"),
        (F.col("observed") == 0).alias("passed"),
    )


def _sum(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def _counts(table: DataFrame, criteria: Mapping[str, Column]) -> DataFrame:
    """One pass over a table, one row per criterion."""
    numbered = dict(enumerate(criteria.items()))
    row = table.agg(*[count.alias(f"_{k}") for k, (_, count) in numbered.items()])
    pairs = [F.struct(F.lit(name).alias("criterion"), F.col(f"_{k}").alias("observed")) for k, (name, _) in numbered.items()]
    return row.select(F.inline(F.array(*pairs)))
