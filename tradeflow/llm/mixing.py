"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.ordered import RANGE, hash60, place_in_ranges, running_totals
from tradeflow.llm.storage import Store, free_name

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BUDGET_PERCENT = 150
EPOCHS = 2
SEED = "mix-1"


def mix_sources(
    docs: DataFrame,
    store: Store,
    weights: Sequence[int] = WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    epochs: int = EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and copies of every row of ``docs``.

    Each source queues its documents in the order of a seeded hash, ``epochs`` times over. A queued copy
    finishes at virtual time (words of the source up to and with it) / (weight of the source). All
    copies are range-sorted by that time and taken as long as their words fit the budget. A source that
    runs out leaves its share to the others by their weights, so the budget is met as if targets above
    ``epochs`` times a source's size had been reshared. No window holds one source: running totals are
    taken over ranges of (source, hash), so a source may have any share of the rows.

    Sources are weighed in code point order, null last, by ``weights`` repeating. A null text has size
    0, is taken 0 times and does not change the mix. Equal rows are documents of their own. With no
    words at all every target is 0. Columns other than doc_id, text and source are not read.
    """
    return _copies(*_line_up(docs, store, weights, budget_percent, epochs, seed), epochs)


def _line_up(
    docs: DataFrame, store: Store, weights: Sequence[int], budget_percent: int, epochs: int, seed: str
) -> tuple[DataFrame, int]:
    """Every copy of every row with the words of all copies before it, and the budget."""
    if any(w <= 0 for w in weights) or not 0 < budget_percent <= 100 * epochs:
        raise ValueError("weights must be positive and the budget at most all epochs")
    spark = docs.sparkSession
    sized = store.keep(
        docs.select(
            "doc_id",
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            _turn(F.col("doc_id"), seed).alias("_turn"),
        ),
        "mix-sizes",
    )
    sources, budget, level = _targets(spark, sized, store, weights, budget_percent, epochs)
    queue = [F.col("_rank"), F.col("_turn"), F.col("doc_id").asc_nulls_first()]
    # A few columns per source, joined on the source: hot sources are spread by adaptive execution, or
    # the table of sources is small enough for Spark to send it.
    ranked = sized.join(sources, sized["source"].eqNullSafe(sources["_source"])).drop("_source")
    queued = running_totals(place_in_ranges(ranked, queue, store, "mix-queue"), queue, ["size"])
    ahead = F.col("size_before") - F.col("_words_before") + F.col("size")
    copies = (
        queued.withColumn("_ahead", ahead)
        .drop(RANGE, "size_before")
        .withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        .withColumn("_finish", (F.col("_epoch") * F.col("source_size") + F.col("_ahead")) / F.col("_weight"))
    )
    turn = [F.col("_finish"), *queue, F.col("_epoch")]
    return running_totals(place_in_ranges(copies, turn, store, "mix-copies"), turn, ["size"]), budget


def _turn(doc_id: Column, seed: str) -> Column:
    return hash60(F.concat(F.lit(seed), doc_id.cast("string")))


def _fits(budget: int) -> Column:
    return F.col("size_before") + F.col("size") <= budget


def _copies(lined_up: DataFrame, budget: int, epochs: int) -> DataFrame:
    copies_taken = F.count_if(_fits(budget))
    # A row's identity is its place in the queue: equal rows stay apart by counting.
    return (
        lined_up.groupBy("doc_id", "source", "size", "source_size", "target")
        .agg(copies_taken.alias("_taken"), (F.count(F.lit(1)) / epochs).cast("int").alias("_rows"))
        .withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("_rows"))))
        .withColumn("copies", (F.floor((F.col("_taken") + F.col("_rows") - F.col("_row")) / F.col("_rows"))).cast("int"))
        .select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
    )


def _targets(
    spark, sized: DataFrame, store: Store, weights: Sequence[int], percent: int, epochs: int
) -> tuple[DataFrame, int, float | None]:
    """One row per source with its target; the budget in words; the virtual time of the last target."""
    per_source = sized.groupBy(F.col("source").alias("_source")).agg(F.sum("size").alias("source_size"))
    by_name = [F.col("_source").asc_nulls_last()]
    named = place_in_ranges(per_source.withColumn("_one", F.lit(1).cast("long")), by_name, store, "mix-sources")
    numbered = running_totals(named, by_name, ["_one", "source_size"])
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), (F.col("_one_before") % len(weights)).cast("int") + 1)
    weighed = numbered.select(
        "_source",
        "source_size",
        F.col("_one_before").alias("_rank"),
        F.col("source_size_before").alias("_words_before"),
        weight.alias("_weight"),
        (F.col("source_size") * epochs).alias("_cap"),
    ).withColumn("_full_at", F.col("_cap") / F.col("_weight"))
    weighed = store.keep(weighed, "mix-weights")
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("_weight"), F.lit(0))).first()
    budget = total[0] * percent // 100
    # Sources fill up in the order of cap / weight; the level is where the budget ends before the next.
    by_level = [F.col("_full_at"), F.col("_rank")]
    levels = running_totals(place_in_ranges(weighed, by_level, store, "mix-levels"), by_level, ["_cap", "_weight"])
    level = (F.lit(budget) - F.col("_cap_before")) / (F.lit(total[1]) - F.col("_weight_before"))
    found = levels.filter(F.col("_full_at") >= level).agg(F.min_by(level, F.struct("_full_at", "_rank"))).first()[0]
    target = F.col("_cap").cast("double") if found is None else F.least(F.col("_cap").cast("double"), F.col("_weight") * F.lit(found))
    return weighed.select("_source", "source_size", "_rank", "_words_before", "_weight", target.alias("target")), budget, found


def mixed_documents(
    docs: DataFrame,
    store: Store,
    weights: Sequence[int] = WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    epochs: int = EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with the columns of ``docs``.

    What the budget takes of a source is the head of its queue, so the last copy taken, one mark per source,
    says of every document with words how often it is in the mix; texts are not shuffled. Documents
    without words share places in the queue and are joined with their own copies. Rows that share doc_id
    and source are taken equally often.
    """
    lined_up, budget = _line_up(docs, store, weights, budget_percent, epochs, seed)
    last = F.max(F.struct("_epoch", "_turn", "doc_id")).alias("_last")
    marks = lined_up.filter(_fits(budget) & (F.col("size") > 0)).groupBy(F.col("source").alias("_marked")).agg(last)
    marks = store.keep(marks, "mix-marks")
    has_word = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    worded, wordless = docs.filter(has_word), docs.filter(~has_word)

    place = F.struct(_turn(worded["doc_id"], seed), worded["doc_id"])
    again = F.when(place <= F.struct(marks["_last"]["_turn"], marks["_last"]["doc_id"]), 1).otherwise(0)
    by_mark = worded.join(marks, worded["source"].eqNullSafe(marks["_marked"]))
    mixed = _repeated(by_mark, worded, marks["_last"]["_epoch"] + again)

    plan = store.keep(_copies(lined_up.filter("size = 0"), budget, epochs).filter("copies > 0"), "mix-wordless")
    own = plan.groupBy(F.col("doc_id").alias("_mixed"), F.col("source").alias("_marked")).agg(F.max("copies").alias("_copies"))
    same = wordless["doc_id"].eqNullSafe(own["_mixed"]) & wordless["source"].eqNullSafe(own["_marked"])
    return mixed.unionByName(_repeated(wordless.join(own, same), wordless, own["_copies"]))


def _repeated(joined: DataFrame, docs: DataFrame, copies: Column) -> DataFrame:
    """The columns of ``docs``, each row ``copies`` times."""
    times = F.explode(F.array_repeat(F.lit(1), copies.cast("int"))).alias(free_name(docs, "_copy"))
    return joined.select(*[docs[c] for c in docs.columns], times).select(*docs.columns)
