"""Latest row per key, and marking the rows a later one replaces, for keys of any frequency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column], hashed: bool = False
) -> DataFrame:
    """One row per key.

    The ``= 1`` filter lets Spark keep one row per key in every map task before the shuffle,
    so a key that holds a third of all rows arrives as one row per task. ``hashed`` puts a hash in
    front of the keys, so that long ids are sorted as numbers; without it the result keeps a
    partitioning that a join on the keys can use.
    """
    source = df.withColumn("_hash", key_hash(keys)) if hashed else df
    partition = ["_hash", *keys] if hashed else keys
    rank = F.row_number().over(Window.partitionBy(*partition).orderBy(*newest_first))
    return source.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_hash", "_rank")


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(key) for key in keys])


def mark_superseded(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column], eligible: Column, flag: str
) -> DataFrame:
    """Add ``flag``: true for an eligible row when another eligible row of its key ranks first.

    One plan for every size: the first window ranks a key's rows within each source partition, the second
    ranks the best of those and leaves all other rows where they are. A group is thus never more than a
    key's share of one source partition, or one row per source partition. Rows that do not take part are
    grouped by their source partition too, so rows with NULL keys never meet in one task.
    """
    within = Window.partitionBy("_hash", *keys, "_in_play", "_slot").orderBy(*newest_first)
    across = Window.partitionBy("_hash", *keys, "_in_play", "_stage").orderBy(*newest_first)
    best = F.col("_in_play") & (F.col("_rank") == 1)
    return (
        df.withColumns({"_in_play": eligible, "_hash": key_hash(keys), "_slot": F.spark_partition_id()})
        .withColumn("_rank", F.row_number().over(within))
        .withColumn("_stage", F.when(best, F.lit(-1)).otherwise(F.col("_slot")))
        .withColumn(flag, F.col("_in_play") & ((F.col("_rank") > 1) | (F.row_number().over(across) > 1)))
        .drop("_in_play", "_hash", "_slot", "_rank", "_stage")
    )


def mark_replaced(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column], eligible: Column, flag: str, row_id: Sequence[str]
) -> DataFrame:
    """``mark_superseded`` for rows that have an identity (``tables.with_row_id``): no window, whatever a key's frequency.

    The best row of a key comes from an aggregate that every map task does for its own rows first, so a
    frequent key arrives as one row per task. Its id is joined back on the id, which is unique: the rows
    themselves are shuffled once, and no key gathers them. ``newest_first`` must be descending, nulls last.
    Of rows that tie in it the one with the greatest id stays.
    """
    first = first_ids(df, keys, newest_first, eligible, row_id, "_first")
    return df.join(first, list(row_id), "left").withColumn(flag, eligible & F.col("_first").isNull()).drop("_first")


def first_ids(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column], eligible: Column, row_id: Sequence[str], flag: str
) -> DataFrame:
    """The identity of the best eligible row of every key, and ``flag``, which is true."""
    ranking = F.struct(*[c.alias(f"_{k}") for k, c in enumerate(newest_first)], *row_id)
    best = df.groupBy(key_hash(keys).alias("_hash"), *keys).agg(F.max(F.when(eligible, ranking)).alias("_best"))
    return best.filter("_best IS NOT NULL").select(*[F.col(f"_best.{c}") for c in row_id], F.lit(True).alias(flag))
