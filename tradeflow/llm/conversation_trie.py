"""A trie of conversation prefixes, with subtree totals by parallel tree contraction."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm.ordered import RANGE
from tradeflow.llm.ranks import in_ranges_of, rank_in_key
from tradeflow.llm.storage import Store

WORD = r"[^\x20\x09-\x0D]+"
#: A conversation takes up to three turns from the first one of its group of twenty.
GROUP, HEADS = 20, 4
#: Two independent names of a turn at its place; together 128 bits.
SEEDS = (1, 2)

TOTALS = ("leaves", "saved")


def borrowed_turns(conv_id: Column) -> Column:
    return F.crc32(F.encode(conv_id.cast("string"), "UTF-8")) % HEADS


def rebuilt_turns(conversations: DataFrame, store: Store) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth from 1, digest, words) of the rebuilt conversations, and (conv_id, turns) of each.

    A conversation's first turns come from the first one of its group, as many as its id's CRC-32 says
    and as there are; its own follow after as many. Texts stay where they are read: turns are named by
    the MD5 of role and text.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    named = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.md5(F.encode(F.concat(F.octet_length(role), F.lit(":"), role, text), "UTF-8")).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    ranked = store.keep(rank_in_key(store.keep(named, "trie-named"), "conv_id", ["turn", "digest"], store, "trie-ranges"), "trie-ranked")
    first = F.col("conv_id") - F.col("conv_id") % GROUP
    own = ranked.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).select("*", first.alias("first"), borrowed_turns(F.col("conv_id")).alias("heads"))
    own = store.keep(own, "trie-own")
    heads = ranked.filter((F.col("conv_id") == first) & (F.col("rank") < HEADS - 1)).select(F.col("conv_id").alias("first"), "rank", "digest", "words")
    there = own.filter("conv_id = first").select("first", F.col("own").alias("there"))
    convs = own.join(there, "first", "left").withColumn("taken", F.least("heads", F.coalesce("there", F.lit(0))))
    convs = store.keep(convs.withColumn("turns", F.col("taken") + F.greatest(F.col("own") - F.col("heads"), F.lit(0))), "trie-convs")
    # At most twenty conversations meet three turns each.
    head = convs.join(heads, "first").filter("rank < taken").select("conv_id", (F.col("rank") + 1).alias("depth"), "digest", "words")
    # A long conversation's rows are split by adaptive execution.
    rest = ranked.join(convs.select("conv_id", "heads", "taken"), "conv_id").filter("rank >= heads")
    rest = rest.select("conv_id", (F.col("taken") + F.col("rank") - F.col("heads") + 1).alias("depth"), "digest", "words")
    return store.keep(head.unionByName(rest), "trie-turns"), convs.select("conv_id", "turns")


def prefix_keys(turns: DataFrame, store: Store) -> DataFrame:
    """``turns`` with the names (k1, k2) of the prefix that ends there and (p1, p2) of the one before.

    A prefix is named by the exclusive or of its turns' names, each taken with its place, so a long
    conversation is named by ranges of its turns: within each range, and over one row per earlier range.
    """
    tags = [F.xxhash64(F.lit(seed), "depth", "digest") for seed in SEEDS]
    ranged = in_ranges_of(turns.withColumns({f"t{k}": tag for k, tag in zip(SEEDS, tags)}), "conv_id", ["depth"], store, "trie-turn-ranges")
    parts = ranged.groupBy(RANGE, "conv_id").agg(*[F.bit_xor(f"t{k}").alias(f"c{k}") for k in SEEDS])
    earlier = Window.partitionBy("conv_id").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(RANGE, "conv_id", *[F.coalesce(F.bit_xor(f"c{k}").over(earlier), F.lit(0)).alias(f"c{k}") for k in SEEDS])
    inside = Window.partitionBy(RANGE, "conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    keyed = ranged.withColumns({f"k{k}": F.bit_xor(f"t{k}").over(inside) for k in SEEDS}).join(carried, [RANGE, "conv_id"])
    for k in SEEDS:
        keyed = keyed.withColumn(f"k{k}", F.col(f"k{k}").bitwiseXOR(F.col(f"c{k}"))).withColumn(f"p{k}", F.col(f"k{k}").bitwiseXOR(F.col(f"t{k}")))
    return keyed.select("conv_id", "depth", "words", "k1", "k2", "p1", "p2")


def _ends(enders: DataFrame, store: Store) -> DataFrame:
    """(node, ends_sha256): SHA-256 of each node's conv_ids, ascending and comma-joined.

    Ids are joined within ranges of (node, conv_id), so a node where very many conversations end is
    written by many tasks; what is hashed one after the other is one text per range, streamed.
    """
    ranged = in_ranges_of(enders, "node", ["conv_id"], store, "trie-end-ranges")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = ranged.groupBy("node", RANGE).agg(ids.alias("piece"))
    parts = int(store.spark.conf.get("spark.sql.shuffle.partitions"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, sha256()
        for batch in batches:
            nodes, done = batch.column("node").to_pylist(), []
            for node, piece in zip(nodes, batch.column("piece").to_pylist()):
                if node != current:
                    if current is not None:
                        done.append((current, state.hexdigest()))
                    current, state = node, sha256(piece.encode("ascii"))
                else:
                    state.update(b"," + piece.encode("ascii"))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["node", "ends_sha256"])
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current]), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    return pieces.repartition(parts, "node").sortWithinPartitions("node", RANGE).mapInArrow(hashed, "node string, ends_sha256 string")


def subtree_totals(tree: DataFrame, store: Store, columns: tuple[str, ...] = TOTALS, name: str = "contract") -> DataFrame:
    """(node, <column>...) for every node: the sums of ``columns`` over its subtree.

    ``tree`` has node, parent (null for roots), children (their number) and the columns, as bigint.

    Each round rakes and compresses. Rake: a node without children is done; its total goes to its parent.
    Compress: a node with one child is taken out where its coin shows heads and its child's tails, so no two
    neighbours of a chain go in one round; its sums are handed to its parent as what the child carries
    beyond its own total, and a record says that its total is the child's total and a known rest. A round
    takes all leaves and a quarter of every chain, so a tree of any depth is done in a number of rounds
    that grows with the logarithm of its size. Records are re-expanded last round first.
    """
    carried = [f"_more_{c}" for c in columns]
    live = tree.select("node", "parent", F.col("children").cast("long").alias("children"), *columns, *[F.lit(0).cast("long").alias(c) for c in carried])
    live = store.keep(live, f"{name}-live-0")
    done: list[DataFrame] = []
    taken: list[DataFrame] = []
    turn = 0
    while not live.isEmpty():
        turn += 1
        leaf = F.col("children") == 0
        done.append(live.filter(leaf).select("node", *columns))
        inner = F.when(~leaf, F.struct("node", *[F.col(c).alias(c) for c in carried]))
        raked = live.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            F.count_if(~leaf).alias("children"),
            F.max(inner).alias("only"),
            *[F.coalesce(F.sum(F.when(leaf, F.col(c) + F.col(f"_more_{c}"))), F.lit(0)).alias(f"_got_{c}") for c in columns],
        )
        coin = lambda node: F.pmod(F.xxhash64(F.lit(turn), node), F.lit(2)) == 1
        rest = live.filter(~leaf).drop("children").join(raked, "node").withColumns({c: F.col(c) + F.col(f"_got_{c}") for c in columns})
        out = (F.col("children") == 1) & F.col("parent").isNotNull() & coin(F.col("node")) & ~coin(F.col("only.node"))
        rest = store.keep(rest.select("node", "parent", "children", *columns, *carried, "only", out.alias("out")), f"{name}-rest-{turn}")
        spliced = rest.filter("out").select(
            F.col("node").alias("gone"),
            F.col("only.node").alias("node"),
            F.col("parent").alias("above"),
            *[(F.col(c) + F.col(f"only._more_{c}")).alias(f"_rest_{c}") for c in columns],
            *[(F.col(c) + F.col(f"_more_{c}")).alias(f"_add_{c}") for c in columns],
        )
        taken.append(spliced.select("gone", "node", *[f"_rest_{c}" for c in columns]))
        handed = spliced.select("node", "above", *[f"_add_{c}" for c in columns])
        live = rest.filter("NOT out").join(handed, "node", "left").select(
            "node",
            F.coalesce("above", "parent").alias("parent"),
            "children",
            *columns,
            *[(F.col(f"_more_{c}") + F.coalesce(f"_add_{c}", F.lit(0))).alias(f"_more_{c}") for c in columns],
        )
        live = store.keep(live, f"{name}-live-{turn}")
    if not done:
        return tree.select("node", *columns)
    known = done.pop()
    for number in range(turn - 1, -1, -1):
        if done:
            known = known.unionByName(done.pop())
        expanded = taken[number].join(known, "node").select(F.col("gone").alias("node"), *[(F.col(c) + F.col(f"_rest_{c}")).alias(c) for c in columns])
        known = known.unionByName(store.keep(expanded, f"{name}-expanded-{number}"))
    return known


def prefix_trie(turns: DataFrame, convs: DataFrame, store: Store) -> DataFrame:
    """One row per distinct prefix of the conversations; see ``conversation_trie``.

    ``turns`` has conv_id, depth (from 1, without gaps), digest and words; ``convs`` has conv_id and turns.
    """
    keyed = store.keep(prefix_keys(turns, store), "trie-keyed")
    members = keyed.unionByName(
        convs.select("conv_id", *[F.lit(0).cast("long").alias(c) for c in ("depth", "words", "k1", "k2")], *[F.lit(None).cast("long").alias(p) for p in ("p1", "p2")])
    )
    nodes = members.groupBy("depth", "k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"), F.min("p1").alias("p1"), F.min("p2").alias("p2")
    )
    nodes = store.keep(nodes.withColumn("node", _name("depth", "conv_id")), "trie-nodes")
    above = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    children = nodes.filter("depth > 0").groupBy(*above).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.join(children, ["depth", "k1", "k2"], "left").select(
        "depth", "k1", "k2", "conv_id", "node", "n_convs", "words", "p1", "p2", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children")
    )
    # A parent of very many children is split by adaptive execution.
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), F.col("node").alias("parent"))
    linked = store.keep(parents.join(up, ["depth", "p1", "p2"], "left"), "trie-linked")
    tree = linked.select(
        "node",
        "parent",
        F.col("n_children").alias("children"),
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    totals = subtree_totals(tree, store, name="trie-contract")
    enders = members.join(convs.withColumnRenamed("turns", "depth"), ["conv_id", "depth"]).select(_name("depth", "k1", "k2").alias("node"), "conv_id")
    ends = _ends(enders, store).withColumnRenamed("node", "ended")
    named = linked.withColumn("ended", _name("depth", "k1", "k2"))
    return named.join(totals, "node").join(ends, "ended", "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(sha256().hexdigest())).alias("ends_sha256"),
    )


def _name(*columns: str) -> Column:
    return F.concat_ws("/", *[F.col(c).cast("string") for c in columns])


def conversation_trie(conversations: DataFrame, store: Store) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every prefix.

    Turns are ordered by turn (null first), equal ones by a digest of role and text, so repeated rows are turns
    of their own. A null role or text is empty, and an empty text has no words. Rows without conv_id belong to
    no conversation. A conversation that is left without turns is a member of the root, and so are all others.
    An empty table gives no rows; other columns are not read. Texts of any length are digested whole where they
    are read. Conversations of any length and prefixes of any number of conversations are worked on in ranges.
    """
    turns, convs = rebuilt_turns(conversations, store)
    return prefix_trie(turns, convs, store)
