"""Validation of the three feeds: typed clean rows, and quarantined rows with raw text and a reason."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.functions.typed import is_missing, is_not_positive, is_not_price, to_double, to_instant, to_long
from tradeflow.operators.latest import first_ids, latest_per_key, mark_superseded
from tradeflow.operators.rules import Rule, label_first
from tradeflow.sources import tables
from tradeflow.sources.schemas import CLEAN, DUPLICATE, PROVENANCE, QUARANTINED, REASON, STATUS


@dataclass(frozen=True)
class Feed:
    """What a feed's rows must satisfy, and the columns both outputs carry."""

    name: str
    columns: tuple[str, ...]
    casts: Mapping[str, Callable[[Column], Column]]
    rules: tuple[Rule, ...]
    flags: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    unique_key: tuple[str, ...] = ()
    newest_by: str | None = None

    def typed(self, column: str) -> Column:
        """The converted value of a labelled frame, or the text where nothing is converted."""
        return F.col(f"_typed_{column}" if column in self.casts else column)

    def ranking(self) -> list[Column]:
        """A total order, greatest first: rows that still tie agree in every column either output carries."""
        rest = [c for c in self.columns if c not in (*self.unique_key, self.newest_by)]
        return [self.typed(self.newest_by), *map(F.col, [*rest, self.newest_by, *PROVENANCE])]

    def newest_first(self) -> list[Column]:
        return [c.desc_nulls_last() for c in self.ranking()]


ORDERS = Feed(
    name="orders",
    columns=("order_id", "product_id", "channel", "quantity", "unit_price", "ordered_at"),
    casts={"quantity": to_long, "unit_price": to_double, "ordered_at": to_instant},
    rules=(
        Rule("MISSING_ORDER_ID", "order_id", is_missing),
        Rule("MISSING_PRODUCT_ID", "product_id", is_missing),
        Rule("INVALID_QUANTITY", "quantity", is_not_positive),
        Rule("INVALID_PRICE", "unit_price", is_not_price),
        Rule("INVALID_TIMESTAMP", "ordered_at", is_missing),
    ),
    unique_key=("order_id",),
    newest_by="ordered_at",
)

INVENTORY = Feed(
    name="inventory",
    columns=("product_id", "warehouse", "quantity", "updated_at"),
    casts={"quantity": to_long, "updated_at": to_instant},
    rules=(
        Rule("MISSING_PRODUCT_ID", "product_id", is_missing),
        Rule("MISSING_WAREHOUSE", "warehouse", is_missing),
        Rule("INVALID_TIMESTAMP", "updated_at", is_missing),
    ),
    # Stock below zero can be a backorder, so it is flagged and kept; unknown stock stays unknown.
    flags={"negative_stock": lambda: F.col("_typed_quantity") < 0},
)

PRICE_EVENTS = Feed(
    name="price_events",
    columns=("product_id", "old_price", "new_price", "changed_at", "source"),
    casts={"old_price": to_double, "new_price": to_double, "changed_at": to_instant},
    rules=(
        Rule("MISSING_PRODUCT_ID", "product_id", is_missing),
        Rule("INVALID_OLD_PRICE", "old_price", is_not_price),
        Rule("INVALID_NEW_PRICE", "new_price", is_not_price),
        Rule("INVALID_TIMESTAMP", "changed_at", is_missing),
    ),
)


def label_rows(raw: DataFrame, feed: Feed) -> DataFrame:
    """Converted columns and the reason of the first failing rule; no shuffle."""
    typed = raw.withColumns({f"_typed_{c}": cast(F.col(c)) for c, cast in feed.casts.items()})
    return label_first(typed, feed.rules, REASON, feed.typed)


def label(raw: DataFrame, feed: Feed) -> DataFrame:
    """``label_rows``, with replaced copies of a key labelled as duplicates."""
    labelled = label_rows(raw, feed)
    if not feed.unique_key:
        return labelled
    marked = mark_superseded(
        labelled, feed.unique_key, feed.newest_first(), F.col(REASON).isNull(), "_superseded"
    )
    reason = F.when(F.col("_superseded"), F.lit(DUPLICATE)).otherwise(F.col(REASON))
    return marked.withColumn(REASON, reason).drop("_superseded")


def label_stored(raw: DataFrame, feed: Feed) -> DataFrame:
    """``label`` for a stored raw table: replaced copies are found through the identity of stored rows.

    Provenance is mostly one value for a whole batch. Such a column breaks no tie, so it is neither ranked nor
    shuffled but put back as a literal. Rows are converted after the join, so typed values are not shuffled either.
    """
    if not feed.unique_key:
        return label_rows(raw, feed)
    same = tables.single_values(raw, PROVENANCE)
    rows = tables.with_row_id(raw.drop(*same))
    labelled = label_rows(rows.withColumns(same), feed)
    first = first_ids(labelled, feed.unique_key, feed.ranking(), F.col(REASON).isNull(), tables.ROW_ID, "_first")
    joined = rows.join(first, list(tables.ROW_ID), "left").withColumns(same).select(*raw.columns, "_first")
    marked = label_rows(joined, feed)
    reason = F.when(F.col(REASON).isNull() & F.col("_first").isNull(), F.lit(DUPLICATE)).otherwise(F.col(REASON))
    return marked.withColumn(REASON, reason).drop("_first")


def select_clean(labelled: DataFrame, feed: Feed) -> DataFrame:
    return labelled.filter(F.col(REASON).isNull()).select(
        *[feed.typed(c).alias(c) for c in feed.columns],
        *[make().alias(flag) for flag, make in feed.flags.items()],
        *PROVENANCE,
    )


def select_quarantined(labelled: DataFrame, feed: Feed) -> DataFrame:
    return labelled.filter(F.col(REASON).isNotNull()).select(*feed.columns, *PROVENANCE, REASON)


def clean(raw: DataFrame, feed: Feed) -> DataFrame:
    """Clean rows alone.

    For a feed with a unique key, each map task keeps the best row per key, valid rows before
    invalid ones, so neither a frequent key nor missing keys are gathered. The reason is tested
    after that: as a filter before it, Spark would copy all conversions into the filter.
    """
    labelled = label_rows(raw, feed)
    if feed.unique_key:
        valid_first = F.col(REASON).asc_nulls_first()
        order = [valid_first, *feed.newest_first()]
        labelled = latest_per_key(labelled, feed.unique_key, order, hashed=True)
    return select_clean(labelled, feed)


def quarantined(raw: DataFrame, feed: Feed) -> DataFrame:
    return select_quarantined(label(raw, feed), feed)


def validate(raw: DataFrame, feed: Feed) -> tuple[DataFrame, DataFrame]:
    return clean(raw, feed), quarantined(raw, feed)


def route(spark: SparkSession, feed: Feed, raw_path: str, routed_path: str) -> tuple[DataFrame, DataFrame]:
    """Write the labelled feed once, as one table with a folder per status; return its clean and its quarantined rows.

    Clean rows hold the typed values and quarantined rows the texts (``<column>_text`` where a value is
    converted) and the reason. Labelling, conversions and the search for replaced copies are done once for both.
    """
    tables.overwrite_parts(routing(label_stored(tables.read(spark, raw_path), feed), feed), routed_path, STATUS)
    return read_routed(spark, feed, routed_path)


def routing(labelled: DataFrame, feed: Feed) -> DataFrame:
    """The columns of a routed table."""
    good = F.col(REASON).isNull()
    values = {c: F.when(good, feed.typed(c)) if c in feed.casts else F.col(c) for c in feed.columns}
    texts = {f"{c}_text": F.when(~good, F.col(c)) for c in feed.casts}
    flags = {flag: F.when(good, make()) for flag, make in feed.flags.items()}
    return labelled.select(
        *[value.alias(name) for name, value in (values | texts | flags).items()],
        *PROVENANCE,
        REASON,
        F.when(good, CLEAN).otherwise(QUARANTINED).alias(STATUS),
    )


def read_routed(spark: SparkSession, feed: Feed, routed_path: str) -> tuple[DataFrame, DataFrame]:
    """Clean and quarantined rows of a routed table; each reads its own folder only, and a missing folder is no rows."""
    nothing = spark.createDataFrame([], ", ".join(f"{c} string" for c in (*feed.columns, *PROVENANCE)))
    schema = routing(label_rows(nothing, feed), feed).schema
    table = spark.read.schema(schema).parquet(routed_path)
    clean_rows = table.filter(F.col(STATUS) == CLEAN).select(*feed.columns, *feed.flags, *PROVENANCE)
    back = [F.col(f"{c}_text" if c in feed.casts else c).alias(c) for c in feed.columns]
    return clean_rows, table.filter(F.col(STATUS) == QUARANTINED).select(*back, *PROVENANCE, REASON)


def process(
    spark: SparkSession, feed: Feed, raw_path: str, clean_path: str, quarantine_path: str
) -> tuple[DataFrame, DataFrame]:
    """Write both tables from the raw one and return what is stored; ``route`` does the work, once for both."""
    good, bad = route(spark, feed, raw_path, f"{clean_path.rstrip('/')}-routed")
    stored = tables.overwrite(good, clean_path), tables.overwrite(bad, quarantine_path)
    tables.drop(spark, f"{clean_path.rstrip('/')}-routed")
    return stored


FEEDS = {feed.name: feed for feed in (ORDERS, INVENTORY, PRICE_EVENTS)}


def validate_orders(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    return validate(raw, ORDERS)


def validate_inventory(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    return validate(raw, INVENTORY)


def validate_price_events(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    return validate(raw, PRICE_EVENTS)


def process_orders(spark: SparkSession, raw_path: str, clean_path: str, quarantine_path: str):
    return process(spark, ORDERS, raw_path, clean_path, quarantine_path)


def process_inventory(spark: SparkSession, raw_path: str, clean_path: str, quarantine_path: str):
    return process(spark, INVENTORY, raw_path, clean_path, quarantine_path)


def process_price_events(spark: SparkSession, raw_path: str, clean_path: str, quarantine_path: str):
    return process(spark, PRICE_EVENTS, raw_path, clean_path, quarantine_path)
