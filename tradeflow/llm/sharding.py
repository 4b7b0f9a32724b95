"""Shards of near equal bytes by sampled splitters."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.ordered import RANGE, hash60, running_totals
from tradeflow.llm.storage import Store

SHARDS = 8
RANGES_PER_SHARD = 16
MAX_RANGES = 4096
BYTES_PER_RANGE = 256 << 20
SAMPLES_PER_RANGE = 32
OVERFULL = 2.0
ROUNDS = 4


def shard_by_bytes(docs: DataFrame, store: Store, shards: int = SHARDS) -> DataFrame:
    """Every row of ``docs`` with its shard, 0 to ``shards - 1``, and its place in the shard.

    Rows are ordered by (hash of the text, doc_id), so equal texts are neighbours and a large group of
    them can still be cut. Keys are sampled with weight proportional to size; the quantiles of the
    sample split the order into ranges, ranges that turn out overfull are sampled again and subdivided,
    and within the ranges exact running totals give the bytes before each row. A shard holds the rows
    whose middle byte lies in its share of all bytes, so shards differ by less than one row's size at
    each end. The sample moves rows between tasks only: it cannot change the result.

    Size is the number of UTF-8 bytes plus 1; a null text has size 1 and a null ``text_crc32``. Rows
    that are equal in all columns get one slot each. Null doc_ids sort first. An empty table gives no
    rows. Other columns of ``docs`` are not read.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    text = F.col("text")
    keys = store.keep(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            hash60(text).alias("_text_key"),
            F.lit(1).cast("long").alias("_one"),
        ),
        "shard-keys",
    )
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    ranged = keys.withColumn(RANGE, range_of(split_points(keys, total, shards)))
    order = [F.col("_text_key"), F.col("doc_id").asc_nulls_first()]
    placed = running_totals(ranged, order, ["size", "_one"])
    middle = 2 * F.col("size_before") + F.col("size")
    shard = F.least(F.floor(middle * shards / (2 * max(total, 1))), F.lit(shards - 1)).cast("int")
    placed = store.keep(placed.select("doc_id", "size", "text_crc32", shard.alias("shard"), "_one_before"), "shard-places")
    # One row per shard.
    first = placed.groupBy(F.col("shard").alias("_shard")).agg(F.min("_one_before").alias("_first"))
    return placed.join(F.broadcast(first), F.col("shard") == F.col("_shard")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_one_before") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


Point = tuple[int, int]


def split_points(keys: DataFrame, total: int, shards: int = SHARDS) -> list[Point]:
    """At most about ``MAX_RANGES`` boundaries between ranges of near equal bytes, in order."""
    ranges = min(MAX_RANGES, max(RANGES_PER_SHARD * shards, total // BYTES_PER_RANGE))
    points = _quantiles(keys, total, ranges)
    for _ in range(ROUNDS):
        filled = keys.groupBy(range_of(points).alias(RANGE)).agg(
            F.sum("size").alias("bytes"), F.max("size").alias("largest")
        )
        share = total / ranges
        over = filled.filter((F.col("bytes") > OVERFULL * share) & (F.col("bytes") > F.col("largest"))).collect()
        if not over or len(points) >= 2 * MAX_RANGES:
            break
        crowded = keys.filter(range_of(points).isin([r[RANGE] for r in over]))
        crowded_bytes = sum(r["bytes"] for r in over)
        finer = _quantiles(crowded, crowded_bytes, int(2 * crowded_bytes / share) + 1)
        if set(finer) <= set(points):
            break
        points = sorted({*points, *finer})
    return points


def _quantiles(keys: DataFrame, total: int, ranges: int) -> list[Point]:
    """Boundaries at equal weight in a sample that takes a row with probability ~ its size.

    The coin of a row is a hash of its key, so a task that runs again draws the same rows. At most
    about ``ranges * SAMPLES_PER_RANGE`` keys are expected, and that many reach the driver.
    """
    wanted = ranges * SAMPLES_PER_RANGE
    coin = F.pmod(F.xxhash64("_text_key", "doc_id", F.lit(total)), F.lit(1 << 40)) / float(1 << 40)
    drawn = (
        keys.filter(coin * total < F.col("size") * wanted)
        .select("_text_key", F.coalesce("doc_id", F.lit(-(1 << 63))), F.greatest("size", F.lit(total // wanted)))
        .collect()
    )
    drawn.sort()
    weights = list(accumulate(r[2] for r in drawn))
    points, step = [], (weights[-1] / ranges if weights else 1)
    for row, until in zip(drawn, weights):
        if until >= (len(points) + 1) * step and len(points) < ranges - 1:
            points.append((row[0], row[1]))
    return sorted(set(points))


def range_of(points: list[Point]) -> Column:
    """Number of boundaries at or below the row's key, by a search in two steps."""
    if not points:
        return F.lit(0)
    key = F.struct(F.col("_text_key").alias("a"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("b"))
    width = max(1, int(len(points) ** 0.5))
    coarse, fine = points[width - 1 :: width], [points[k : k + width] for k in range(0, len(points), width)]
    above = F.size(F.filter(_points(coarse), lambda p: p <= key))
    nested = F.array(*[_points(part) for part in fine], F.filter(_points(fine[-1]), lambda p: F.lit(False)))
    within = F.size(F.filter(F.element_at(nested, above + 1), lambda p: p <= key))
    return above * width + within


def _points(points: list[Point]) -> Column:
    return F.array(*[F.struct(_long(a).alias("a"), _long(b).alias("b")) for a, b in points])


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")
