"""Counts and assertions over tables. Each function that checks several columns reads the table once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.sources.schemas import DUPLICATE, REASON


def reason_counts(quarantined: DataFrame) -> DataFrame:
    return quarantined.groupBy(REASON).agg(F.count(F.lit(1)).alias("rows"))


def quarantine_summary(quarantined: DataFrame) -> dict[str, int]:
    """Reason → rows; the number of reasons is fixed by the rules."""
    return {row[REASON]: row["rows"] for row in reason_counts(quarantined).collect()}


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def nonpositive_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL is not counted, zero is."""
    return df.agg(*[F.count_if(F.col(c) <= 0).alias(c) for c in columns])


def assert_no_nulls(df: DataFrame, *columns: str) -> None:
    _raise_on(null_counts(df, columns), "null")


def assert_all_positive(df: DataFrame, *columns: str) -> None:
    _raise_on(nonpositive_counts(df, columns), "non-positive")


def _raise_on(counts: DataFrame, kind: str) -> None:
    found = [f"'{c}' has {n} {kind} values" for c, n in counts.first().asDict().items() if n]
    if found:
        raise AssertionError("column " + ", ".join(found))


def uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: all rows, distinct keys, and whether they agree."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
    ).withColumn("is_unique", F.col("rows") == F.col("distinct_keys"))


def label_totals(labelled: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(reason, rows) of a feed whose rows are labelled by the rules alone; NULL counts the clean rows.

    Copies that a later row replaces are not marked to be counted: among the rows without a reason, one
    per key is clean and the others are duplicates. Only keys and counts move, summed in the map tasks first.
    """
    passed = F.col(REASON).isNull()
    per_key = labelled.groupBy(REASON, *[F.when(passed, F.col(k)).alias(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    totals = per_key.groupBy(REASON).agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_keys"))
    split = F.array(
        F.struct(F.col(REASON).alias("reason"), F.when(passed & F.lit(bool(keys)), F.col("_keys")).otherwise(F.col("_n")).alias("rows")),
        F.struct(F.lit(DUPLICATE).alias("reason"), F.when(passed & F.lit(bool(keys)), F.col("_n") - F.col("_keys")).otherwise(0).alias("rows")),
    )
    counted = totals.select(F.inline(split)).filter("rows > 0")
    return counted.groupBy(F.col("reason").alias(REASON)).agg(F.sum("rows").alias("rows"))


def reconcile_totals(totals: DataFrame) -> DataFrame:
    """``reconciliation`` from ``label_totals``."""
    sum_of = lambda which: F.coalesce(F.sum(F.when(which, F.col("rows"))), F.lit(0))
    clean, quarantined = sum_of(F.col(REASON).isNull()), sum_of(F.col(REASON).isNotNull())
    return totals.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("raw_rows"),
        clean.alias("clean_rows"),
        quarantined.alias("quarantined_rows"),
        sum_of(F.col(REASON) == DUPLICATE).alias("duplicate_rows"),
    ).withColumn("balanced", F.col("raw_rows") == F.col("clean_rows") + F.col("quarantined_rows"))


def reconciliation(labelled: DataFrame) -> DataFrame:
    """One row over a labelled table: every raw row is either clean or quarantined."""
    clean = F.count_if(F.col(REASON).isNull())
    quarantined = F.count_if(F.col(REASON).isNotNull())
    return labelled.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        clean.alias("clean_rows"),
        quarantined.alias("quarantined_rows"),
        F.count_if(F.col(REASON) == DUPLICATE).alias("duplicate_rows"),
        (clean + quarantined == F.count(F.lit(1))).alias("balanced"),
    )
