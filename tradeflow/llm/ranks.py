"""Places of rows within their key, with no task that sees all rows of a frequent key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm.ordered import RANGE, place_in_ranges
from tradeflow.llm.storage import Store

PLACE = "_place"


def in_ranges_of(df: DataFrame, key: str, order: Sequence[str], store: Store, name: str) -> DataFrame:
    """Store ``df`` in ranges of (key, order), nulls first. Rows equal in all of these spread over ranges too."""
    return place_in_ranges(df.withColumn(PLACE, F.monotonically_increasing_id()), [F.col(c) for c in (key, *order, PLACE)], store, name)


def earlier_ranges(ranged: DataFrame, key: str, **sums: Column) -> DataFrame:
    """Per range and key: each aggregate of the key's rows in all earlier ranges, as ``<name>_before``, and in all, as ``<name>_all``.

    One row per range and key is made before anything is ordered, so a frequent key has as many rows as ranges.
    """
    parts = ranged.groupBy(RANGE, key).agg(*[aggregate.alias(name) for name, aggregate in sums.items()])
    whole = Window.partitionBy(key)
    earlier = whole.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        RANGE,
        key,
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"{name}_before") for name in sums],
        *[F.sum(name).over(whole).alias(f"{name}_all") for name in sums],
    )


def rank_in_key(df: DataFrame, key: str, order: Sequence[str], store: Store, name: str) -> DataFrame:
    """``df`` with ``rank`` (gapless from 0 in its key by ``order``, nulls first) and ``of`` (rows of the key); ``key`` holds no null.

    A key with a third of all rows is ranked by as many tasks as its ranges have.
    """
    ranged = in_ranges_of(df, key, order, store, name)
    starts = earlier_ranges(ranged, key, rows=F.count(F.lit(1)))
    inside = Window.partitionBy(RANGE, key).orderBy(*order, PLACE)
    placed = ranged.withColumn("rank", F.row_number().over(inside).cast("long") - 1)
    return placed.join(starts, [RANGE, key]).select(
        *df.columns, (F.col("rank") + F.col("rows_before")).alias("rank"), F.col("rows_all").alias("of")
    )
