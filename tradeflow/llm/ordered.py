"""Running totals over a whole table in a total order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm.storage import Store

RANGE = "_range"
ROWS_PER_RANGE = 1_000_000
LEAST_RANGES = 12


def hash60(text: Column) -> Column:
    """First 60 bits of the MD5 of a text as a number; -1 for null. Any SQL engine can compute it."""
    return F.coalesce(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint"), F.lit(-1))


def place_in_ranges(df: DataFrame, order: Sequence[Column], store: Store, name: str) -> DataFrame:
    """Store ``df`` in ranges of ``order``; ``_range`` numbers them. Keys must have few equal rows."""
    rows = df.count()
    ranges = max(LEAST_RANGES, -(-rows // ROWS_PER_RANGE))
    return store.keep(df.repartitionByRange(ranges, *order).withColumn(RANGE, F.spark_partition_id()), name)


def running_totals(ranged: DataFrame, order: Sequence[Column], totals: Sequence[str]) -> DataFrame:
    """Add ``<column>_before`` for each column: its sum over all rows that come first.

    ``_range`` must follow ``order``. Each range is summed and ordered in its own task; between ranges
    only one row per range moves.
    """
    sums = ranged.groupBy(RANGE).agg(*[F.sum(c).alias(f"_sum_{c}") for c in totals])
    earlier = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col(RANGE).alias("_start_range"),
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_start_{c}") for c in totals],
    )
    inside = Window.partitionBy(RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.join(starts, F.col(RANGE) == F.col("_start_range"))
        .withColumns(
            {f"{c}_before": F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_start_{c}") for c in totals}
        )
        .drop("_start_range", *[f"_start_{c}" for c in totals])
    )
