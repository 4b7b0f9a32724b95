"""Near-duplicate texts by ProbMinHash signatures of shingle sets, banding and verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm import text_arrays as ta
from tradeflow.llm.components import components
from tradeflow.llm.storage import Store, free_name

SHINGLE_WORDS = 5
LEAST_SIMILARITY = 0.8
#: Two texts of similarity 0.8 share no band with probability (1 - 0.8**4)**20 = 0.00003.
BANDS = 20
ROWS_PER_BAND = 4
#: They agree in fewer than 50 of the 80 components with probability 0.0001.
LEAST_AGREEMENT = 50
#: Smallest shingle hashes kept of a text, and the similarity they must show before verification: 4 deviations below 0.8.
SKETCH_SHINGLES, LEAST_ESTIMATE = 256, 0.7
#: A task compares at most about this many texts with this many others of one bucket.
PROBES, TARGETS = 256, 2048
JOINED_PAIRS = 4096
#: Text that a worker looks at together; it bounds what a worker holds.
BLOCK_BYTES = 1 << 19


def weighted_shingles(words: ta.Words, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, weight): the weight of a shingle found n times in its text is 1 + ln n.

    A text of fewer words than a shingle has is one shingle.
    """
    row, value, times = ta.counted(*words.grams(size, whole=True))
    return row, value, 1 + np.log(times)


def prob_min_hash(row: np.ndarray, value: np.ndarray, weight: np.ndarray, rows: int, size: int) -> np.ndarray:
    """ProbMinHash signatures: component k of a row is the element that arrives there first.

    Each element is a Poisson process of its weight's rate; every arrival falls into a random component.
    All of a row's elements are stepped together, and one stops as soon as it is later than the latest
    first arrival of its row's components. Two rows agree in a component with the probability Jaccard
    similarity of their weighted elements.
    """
    earliest = np.full(rows * size, np.inf)
    element = np.zeros(rows * size, np.uint64)
    time, step = np.zeros(len(row)), 0
    while len(row):
        step += 1
        coin = ta.mix(value + np.uint64(step * int(ta.GOLDEN) % 2**64))
        time = time - np.log(((coin >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53) / weight
        cell = row * size + (ta.mix(coin ^ ta.MIX_1) % np.uint64(size)).astype(np.int64)
        np.minimum.at(earliest, cell, time)
        first = earliest[cell] == time
        element[cell[first]] = value[first]
        going = time < earliest.reshape(rows, size).max(axis=1)[row]
        row, value, weight, time = row[going], value[going], weight[going], time[going]
    return element.reshape(rows, size)


def band_keys(signatures: np.ndarray, bands: int, per_band: int) -> np.ndarray:
    """One 64-bit key per row and band, different for different bands."""
    keys = np.zeros((len(signatures), bands), np.uint64)
    for k in range(per_band):
        keys = ta.mix(keys * ta.GOLDEN + signatures[:, k::per_band] + np.uint64(1))
    return ta.mix(keys + np.arange(bands, dtype=np.uint64))


SKETCH = "words long, key_1 long, key_2 long, shingles long, bands array<long>, signature binary"


def sketch(column: pa.Array, bands: int = BANDS, per_band: int = ROWS_PER_BAND) -> pa.StructArray:
    """Per text: words, a 128-bit name of its word sequence, distinct shingles, band keys, signature.

    One byte of each component is kept of the signature, for estimates before verification.
    """
    parts = []
    for start, end in ta.blocks(column, BLOCK_BYTES):
        words = ta.Words(column.slice(start, end - start))
        row, value, _ = weighted_shingles(words)
        # Weight 1: components agree with the Jaccard similarity that links are verified on.
        signatures = prob_min_hash(row, value, np.ones(len(row)), words.rows, bands * per_band)
        name = _text_name(words)
        shingles = np.bincount(row, minlength=words.rows)
        short = (signatures >> np.uint64(56)).astype(np.uint8)
        parts.append((words.count, name[0], name[1], shingles, band_keys(signatures, bands, per_band), short))
    empty = [np.zeros(0)] * 4 + [np.zeros((0, bands)), np.zeros((0, bands * per_band), np.uint8)]
    flat = [np.concatenate(p) for p in zip(*parts)] if parts else empty
    columns = [pa.array(x.astype(np.uint64).view(np.int64)) for x in flat[:4]]
    keys = flat[4].astype(np.uint64).view(np.int64)
    starts = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * bands)
    columns.append(pa.ListArray.from_arrays(starts, pa.array(keys.ravel())))
    columns.append(pa.array([row.tobytes() for row in flat[5]], pa.binary()))
    return pa.StructArray.from_arrays(columns, ["words", "key_1", "key_2", "shingles", "bands", "signature"])


def _agreement(a: pa.Array, b: pa.Array) -> pa.Array:
    """Number of equal components of two signatures."""
    return pa.array((_matrix(a) == _matrix(b)).sum(axis=1), pa.int32())


def _matrix(signatures: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(signatures.to_pylist()), np.uint8).reshape(len(signatures), -1)


def _sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield sketch(ta.as_large(batch))
    ta.give_back()


def _text_name(words: ta.Words) -> np.ndarray:
    """A 128-bit name of each row's word sequence; zero for a row without words."""
    has = np.flatnonzero(words.count > 0)
    name = np.zeros((2, words.rows), np.uint64)
    name[0, has] = words._hash_runs(words.first[has], words.count[has])
    sums = np.concatenate([[np.uint64(0)], np.cumsum(ta.mix(words.hash + ta.GOLDEN))])
    name[1] = sums[words.first + words.count] - sums[words.first]
    return name


def _named(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        column, names = ta.as_large(batch), [np.zeros((2, 0), np.uint64)]
        for start, end in ta.blocks(column, BLOCK_BYTES):
            names.append(_text_name(ta.Words(column.slice(start, end - start))))
        keys = np.concatenate(names, axis=1).view(np.int64)
        yield pa.StructArray.from_arrays([pa.array(k) for k in keys], ["key_1", "key_2"])
    ta.give_back()


def _shingle_set(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        column, values, counts, names = ta.as_large(batch), [], [], [np.zeros((2, 0), np.uint64)]
        for start, end in ta.blocks(column, BLOCK_BYTES):
            words = ta.Words(column.slice(start, end - start))
            row, value, _ = ta.counted(*words.grams(SHINGLE_WORDS, whole=True))
            values.append(value)
            counts.append(np.bincount(row, minlength=words.rows))
            names.append(_text_name(words))
        ends = np.cumsum(np.concatenate(counts)) if counts else np.zeros(0)
        flat = np.concatenate(values).view(np.int64) if values else np.zeros(0, np.int64)
        grams = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
        keys = np.concatenate(names, axis=1).view(np.int64)
        yield pa.StructArray.from_arrays([grams, *[pa.array(k) for k in keys]], ["grams", "key_1", "key_2"])
    ta.give_back()


KEYS = ["key_1", "key_2"]
#: Spark's own runtime filter, whatever the sizes: texts that are not wanted are dropped before the shuffle.
ONLY_WANTED = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1t",
}


def near_duplicate_classes(docs: DataFrame, store: Store, least: float = LEAST_SIMILARITY) -> DataFrame:
    """doc_id, class_id, kept and words of every row of ``docs``.

    Two texts are linked when the sets of their five-word shingles have a Jaccard similarity of at least
    ``least``; a class is a connected component of links, named by its smallest doc_id, and that document
    is kept. Candidates are texts that share a band of their ProbMinHash signatures; each link is verified
    on the shingles themselves.

    Texts of the same words are one candidate. In a bucket, all texts are first compared with its hub, the
    text that shares most buckets with others, so a large group of near copies takes as many comparisons
    as it has texts. Then all pairs of a bucket that are still in different classes are compared, in blocks
    where the bucket is large. No bucket is capped.

    Rows are told apart by their texts: rows with equal doc_id and different texts are classed each by its
    own text, and of two such texts in one class one is kept. A text that is null or has no words, and a row
    with a null doc_id, is in no class but its own. Rows equal in doc_id and text get equal results; all but
    one of them fall out where documents are dropped (``distinct_documents``). An empty table gives no rows;
    other columns are not read.
    """
    return _classes(docs, store, least).select("doc_id", "class_id", "words", "kept")


def _classes(docs: DataFrame, store: Store, least: float) -> DataFrame:
    """``near_duplicate_classes`` with the names (key_1, key_2) of the texts."""
    sketched = docs.select("doc_id", F.arrow_udf(_sketch, SKETCH)("text").alias("s")).select("doc_id", "s.*")
    sketched = store.keep(sketched, "near-sketches")
    usable = sketched.filter("words > 0 AND doc_id IS NOT NULL")
    first = F.min(F.struct("doc_id", "shingles", "bands", "signature")).alias("t")
    # The number that a text gets is kept with it, so every later step sees the same one.
    texts = usable.groupBy(*KEYS).agg(first, F.count(F.lit(1)).alias("rows"))
    texts = texts.select(*KEYS, "rows", "t.*", F.monotonically_increasing_id().alias("id"))
    texts = store.keep(texts, "near-texts")
    nodes = texts.drop("doc_id", "rows", *KEYS).withColumnRenamed("id", "doc_id")
    members = _bucket_members(nodes, store)
    grams = _shingles_of(docs, members, texts, store)
    labels = _link(members, nodes, grams, store, least)
    placed = texts.join(labels, texts["id"] == labels["node"], "left").select(*KEYS, "doc_id", F.coalesce("component", "id").alias("component"))
    placed = store.keep(placed, "near-placed")
    kept = placed.groupBy("component").agg(F.min(F.struct("doc_id", *KEYS)).alias("kept"))
    # A class with very many texts, and a text with very many rows, are split by adaptive execution.
    named = placed.join(kept, "component").select(
        *KEYS, F.col("kept.doc_id").alias("class_id"), (F.struct("doc_id", *KEYS) == F.col("kept")).alias("is_kept")
    )
    named = store.keep(named, "near-classes")
    classed = (F.col("words") > 0) & F.col("doc_id").isNotNull()
    return sketched.join(named, KEYS, "left").select(
        "doc_id",
        *KEYS,
        F.when(classed, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        "words",
        F.when(classed, F.col("is_kept") & (F.col("doc_id") == F.col("class_id"))).otherwise(True).alias("kept"),
    )


def _bucket_members(texts: DataFrame, store: Store) -> DataFrame:
    """(bucket, band, doc_id, shingles, signature, central) of all texts in buckets of two or more.

    ``central`` is the number of texts in all of a text's buckets. The original of a group of edited
    copies resembles all of them and has the highest.
    """
    exploded = texts.select("doc_id", "shingles", "signature", F.posexplode("bands").alias("band", "bucket"))
    sizes = exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    shared = store.keep(exploded.join(sizes, "bucket"), "near-shared")
    central = shared.groupBy("doc_id").agg(F.sum("texts").alias("central"))
    return store.keep(shared.join(central, "doc_id").select("bucket", "band", "doc_id", "shingles", "signature", "central"), "near-members")


def _shingles_of(docs: DataFrame, members: DataFrame, texts: DataFrame, store: Store) -> DataFrame:
    """(id, grams): the shingles of every text that shares a bucket.

    Few texts share one, so a Bloom filter of their doc_ids goes before the join: the others are not shuffled.
    """
    wanted = members.select(F.col("doc_id").alias("id")).distinct().join(texts.select("id", "doc_id", "rows", *KEYS), "id")
    wanted = store.keep(wanted.select("id", "doc_id", "rows", *[F.col(k).alias(f"_{k}") for k in KEYS]), "near-wanted")
    # Spark builds the filter only from a side that itself is filtered; every text has rows.
    found = docs.select("doc_id", "text").join(wanted.filter("rows > 0"), "doc_id")
    # Not deterministic for Spark: it would run the function once more for the comparison of names.
    shingles = F.arrow_udf(_shingle_set, "grams array<long>, key_1 long, key_2 long").asNondeterministic()
    made = found.select("id", "rows", *[f"_{k}" for k in KEYS], shingles("text").alias("s"))
    own = made.filter((F.col("s.key_1") == F.col("_key_1")) & (F.col("s.key_2") == F.col("_key_2")))
    with store.settings(ONLY_WANTED):
        own = store.keep(own.select("id", "rows", F.col("s.grams").alias("grams")), "near-shingles")
    # A text with one row has one row here. Of others, rows equal in doc_id too may have come: one of them counts.
    again = own.filter("rows > 1").groupBy("id").agg(F.first("grams").alias("grams"))
    return own.filter("rows = 1").select("id", "grams").unionByName(store.keep(again, "near-shingles-again"))


def _link(members: DataFrame, texts: DataFrame, grams: DataFrame, store: Store, least: float) -> DataFrame:
    """Classes of all linked texts: every bucket's hub first, then the pairs that are still apart."""
    hub_pairs = store.keep(_hub_pairs(members, store, least), "near-pairs-1")
    links = store.keep(_verified(hub_pairs, grams, least), "near-links-1")
    labels = components(links, store, "near-components-1")
    apart = store.keep(_apart(members, labels, store), "near-apart")
    pairs = store.keep(_pairs_apart(apart, texts, grams, store, least), "near-pairs-2")
    more = store.keep(_verified(pairs, grams, least), "near-links-2")
    return labels if more.isEmpty() else components(links.union(more), store, "near-components-2")


def _apart(members: DataFrame, labels: DataFrame, store: Store) -> DataFrame:
    """Members, with their classes, of buckets that hold two classes or more."""
    current = members.join(labels, members["doc_id"] == labels["node"], "left").select(
        "bucket", "band", "doc_id", "shingles", "signature", F.coalesce("component", "doc_id").alias("component")
    )
    current = store.keep(current, "near-current")
    per_class = current.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    per_bucket = per_class.groupBy("bucket").agg(
        F.sum("n").alias("texts"), F.max("n").alias("_most"), F.max_by("component", F.struct("n", "component")).alias("largest")
    )
    split = per_bucket.filter("_most < texts").select("bucket", "texts", "largest", (F.col("texts") - F.col("_most")).alias("others"))
    return current.join(split, "bucket")


def _pairs_apart(apart: DataFrame, texts: DataFrame, grams: DataFrame, store: Store, least: float) -> DataFrame:
    """Pairs of one bucket in different classes whose signatures agree enough, each once.

    One of a pair is outside the bucket's largest class: it is the probe, and the other the target.
    Small buckets are joined. In the others, probes and targets are dealt into blocks of bounded size,
    every block of probes meets every block of targets, each pair only in the first band whose keys are equal. Only
    pairs whose smallest shingle hashes are alike too leave the task; below ``SKETCH_SHINGLES`` that is exact.
    """
    small = F.col("texts") * F.col("others") <= JOINED_PAIRS
    probe = F.col("component") != F.col("largest")
    # Stored, so that Spark knows their size before it plans to move the shingles of all texts.
    few, many = apart.filter(small), store.keep(apart.filter(~small), "near-many")
    lowest = grams.select(F.col("id").alias("doc_id"), F.slice("grams", 1, SKETCH_SHINGLES).alias("lowest"))
    many = many.join(lowest, "doc_id").join(texts.select("doc_id", "bands"), "doc_id")
    other = few.select(
        "bucket",
        F.col("doc_id").alias("hub"),
        F.col("shingles").alias("hub_shingles"),
        F.col("component").alias("hub_class"),
        F.col("signature").alias("hub_signature"),
    )
    once = (F.col("hub_class") == F.col("largest")) | (F.col("doc_id") < F.col("hub"))
    joined = few.filter(probe).join(other, "bucket").filter(once & (F.col("component") != F.col("hub_class")))
    joined = _agreeing(joined.filter(_compatible(least)))

    probe_blocks = F.ceil(F.col("others") / PROBES).cast("int")
    target_blocks = F.ceil(F.col("texts") / TARGETS).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    dealt = lambda n, seed: F.pmod(F.xxhash64("doc_id", F.lit(seed)), n).cast("int")
    kept = ["bucket", "band", "doc_id", "shingles", "component", "signature", "lowest", "bands"]
    probes = many.filter(probe).select(*kept, F.lit(True).alias("probe"), dealt(probe_blocks, 1).alias("p"), all_of(target_blocks).alias("t"))
    targets = many.select(*kept, F.lit(False).alias("probe"), dealt(target_blocks, 2).alias("t"), all_of(probe_blocks).alias("p"))
    blocks = probes.unionByName(targets).groupBy("bucket", "p", "t")
    compared = blocks.applyInArrow(_block_comparer(least), "doc_id long, hub long")
    return joined.unionByName(compared).distinct()


def _block_comparer(least: float):
    def compare(block: pa.Table) -> pa.Table:
        """Pairs of a probe and a target of another class that may be similar enough."""
        ids, classes, sizes = (block[c].to_numpy() for c in ("doc_id", "component", "shingles"))
        probe, band = np.asarray(block["probe"]), block["band"][0].as_py()
        signatures = _matrix(block["signature"].combine_chunks())
        keys = block["bands"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        # Lists hold unsigned hashes, smallest first.
        lowest = block["lowest"].combine_chunks()
        flat, cut = lowest.flatten().to_numpy().view(np.uint64), lowest.offsets.to_numpy() - lowest.offsets[0].as_py()
        targets = np.flatnonzero(~probe)
        pairs = []
        for k in np.flatnonzero(probe):
            agree = (signatures[targets] == signatures[k]).sum(axis=1)
            # Bytes may agree in a band whose keys differ, so the keys themselves are compared.
            first = (keys[targets] == keys[k]).argmax(axis=1)
            possible = (agree >= LEAST_AGREEMENT) & (first == band) & (classes[targets] != classes[k])
            small, large = np.minimum(sizes[targets], sizes[k]), np.maximum(sizes[targets], sizes[k])
            own = flat[cut[k] : cut[k + 1]]
            for other in targets[possible & (small >= least * large)]:
                if _estimate(own, flat[cut[other] : cut[other + 1]]) >= (least if max(sizes[k], sizes[other]) < SKETCH_SHINGLES else LEAST_ESTIMATE):
                    pairs.append((min(ids[k], ids[other]), max(ids[k], ids[other])))
        found = np.array(pairs, np.int64).reshape(-1, 2)
        return pa.table({"doc_id": found[:, 0], "hub": found[:, 1]})

    return compare


def _estimate(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity from the smallest hashes of two sets; exact where the lists are whole sets."""
    both = np.sort(np.concatenate([a, b]))
    twice = both[1:] == both[:-1]
    distinct = np.concatenate([[True], ~twice])
    within = np.flatnonzero(distinct)[:SKETCH_SHINGLES] if max(len(a), len(b)) >= SKETCH_SHINGLES else np.flatnonzero(distinct)
    last = within[-1] if len(within) else 0
    return np.count_nonzero(twice[: last + 1]) / max(len(within), 1)


def _agreeing(pairs: DataFrame) -> DataFrame:
    """Different pairs whose signatures agree enough."""
    agree = F.arrow_udf(_agreement, "int")("signature", "hub_signature")
    return (
        pairs.filter(agree >= LEAST_AGREEMENT)
        .select(F.least("doc_id", "hub").alias("doc_id"), F.greatest("doc_id", "hub").alias("hub"))
        .distinct()
    )


def _compatible(least: float) -> Column:
    """Sets whose sizes differ more cannot reach the similarity."""
    return F.least("shingles", "hub_shingles") >= F.lit(least) * F.greatest("shingles", "hub_shingles")


def _hub_pairs(members: DataFrame, store: Store, least: float) -> DataFrame:
    """Pairs of every bucket's hub with the other members, each once."""
    rank = F.struct("central", -F.col("doc_id"))
    hub = F.max_by(F.struct("doc_id", "shingles", "signature"), rank).alias("hub")
    hubs = store.keep(
        members.groupBy("bucket").agg(hub).select(
            "bucket",
            F.col("hub.doc_id").alias("hub"),
            F.col("hub.shingles").alias("hub_shingles"),
            F.col("hub.signature").alias("hub_signature"),
        ),
        "near-hubs",
    )
    return _agreeing(members.join(hubs, "bucket").filter("doc_id <> hub").filter(_compatible(least)))


def _verified(pairs: DataFrame, grams: DataFrame, least: float) -> DataFrame:
    """Links (u, v) among stored ``pairs``. Shingles of a text are moved only where one of its pairs is checked."""
    of_pairs = lambda side: grams.join(pairs.select(F.col(side).alias("id")).distinct(), "id", "left_semi")
    a = of_pairs("doc_id").select(F.col("id").alias("doc_id"), F.col("grams").alias("a"))
    b = of_pairs("hub").select(F.col("id").alias("hub"), F.col("grams").alias("b"))
    common = F.size(F.array_intersect("a", "b"))
    return (
        pairs.join(a, "doc_id")
        .join(b, "hub")
        .select("doc_id", "hub", common.alias("c"), (F.size("a") + F.size("b")).alias("n"))
        .filter(F.col("c") >= F.lit(least) * (F.col("n") - F.col("c")))
        .select(F.col("doc_id").alias("u"), F.col("hub").alias("v"))
    )


def distinct_documents(docs: DataFrame, store: Store, least: float = LEAST_SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose text is the one kept of its class.

    Rows with equal doc_id and different texts are decided each by its own text; of rows equal in both one
    stays. Rows without doc_id, and rows whose text is null or has no words, stay. An empty table gives no
    rows; extra columns are passed on as they are. See ``near_duplicate_classes``.
    """
    classes = store.keep(_classes(docs, store, least).filter("doc_id IS NOT NULL AND words > 0"), "near-decided")
    per_id = classes.groupBy("doc_id").agg(F.bool_and("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
    decided = store.keep(per_id.filter("rows > 1 OR NOT kept").select("doc_id", "rows"), "near-drops")
    single = docs.join(decided, "doc_id", "left_anti")
    repeated = decided.filter("rows > 1")
    if repeated.isEmpty():
        return single.unionByName(_wordless(docs.join(decided, "doc_id", "left_semi")))
    name = free_name(docs, "_text_name")
    again = docs.join(decided, "doc_id", "left_semi").withColumn(name, F.arrow_udf(_named, "key_1 long, key_2 long")("text"))
    stay = classes.filter("kept").join(repeated, "doc_id", "left_semi").select(F.col("doc_id").alias("_doc"), *[F.col(k).alias(f"_{k}") for k in KEYS]).distinct()
    same = (F.col("doc_id") == F.col("_doc")) & (F.col(name)["key_1"] == F.col("_key_1")) & (F.col(name)["key_2"] == F.col("_key_2"))
    chosen = again.join(stay, same, "left_semi").dropDuplicates(["doc_id", name]).drop(name)
    return single.unionByName(chosen).unionByName(_wordless(again.drop(name)))


def _wordless(docs: DataFrame) -> DataFrame:
    return docs.filter(F.coalesce(F.trim(F.translate("text", "\t\n\x0b\x0c\r", "     ")), F.lit("")) == "")
