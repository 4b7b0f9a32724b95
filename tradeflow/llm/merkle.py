"""A Merkle manifest of a table: one tree per language, a tree over their roots, proofs from a postorder log.

The log holds a tree's nodes in the order in which they are complete: a node follows its last child at
once. With runs of eight, a leaf's place follows from its number alone, as all runs before it are
complete, and an inner node stands as many places behind its last leaf as its level is high. So a
sibling's place in the log is a formula, and no links or lookups are stored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.ranks import rank_in_key
from tradeflow.llm.storage import Store

ARITY = 8
#: Levels that one builder adds: it reads an aligned block of 8**3 nodes and writes their subtree.
BUILDER_LEVELS = 3
BLOCK = ARITY**BUILDER_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

SEGMENT = "tree string, block long, of long, leaves long, level int, digests array<string>, top string"
PATH = "tree string, node long, lefts array<string>, rights array<string>, subroot string, root string"
ABOVE = ("lefts", "rights", "subroot", "root")


def digest(parts: Sequence[str]) -> str:
    return sha256("".join(parts).encode("ascii")).hexdigest()


def height(leaves: int) -> int:
    """Levels above the leaves until one node remains."""
    levels, reach = 0, 1
    while reach < leaves:
        levels, reach = levels + 1, reach * ARITY
    return levels


def log_position(level: int, index: int, leaves: int, levels: int) -> int:
    """Place of a node in the postorder log of a tree (or aligned block) with ``leaves`` leaves and ``levels`` levels above them.

    Before the node's last leaf stand the leaves before it and every run that ended there; after it, the
    nodes that it completes, lowest first.
    """
    last = min((index + 1) * ARITY**level, leaves) - 1
    return last + sum(last // ARITY**k for k in range(1, levels + 1)) + level


def append_log(leaves: Sequence[str], levels: int) -> list[str]:
    """Digests of a block's nodes in completion order; the last one is the block's top."""
    log: list[str] = []
    open_runs: list[list[str]] = [[] for _ in range(levels + 1)]

    def append(node: str, level: int) -> None:
        log.append(node)
        open_runs[level].append(node)
        if level < levels and len(open_runs[level]) == ARITY:
            close(level)

    def close(level: int) -> None:
        run, open_runs[level] = open_runs[level], []
        append(digest(run), level + 1)

    for leaf in leaves:
        append(leaf, 0)
    for level in range(levels):
        if open_runs[level]:
            close(level)
    return log


def siblings(log: Sequence[str], index: int, leaves: int, levels: int) -> tuple[list[str], list[str]]:
    """Per level, the digests left and right of the path from leaf ``index`` to the block's top."""
    lefts, rights, width = [], [], leaves
    for level in range(levels):
        first = index - index % ARITY
        run = [log[log_position(level, k, leaves, levels)] for k in range(first, min(first + ARITY, width))]
        lefts.append("".join(run[: index - first]))
        rights.append("".join(run[index - first + 1 :]))
        index, width = index // ARITY, -(-width // ARITY)
    return lefts, rights


def fold(leaf: str, lefts: Sequence[str], rights: Sequence[str]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in zip(lefts, rights):
        leaf = digest((left, leaf, right))
    return leaf


class Forest(NamedTuple):
    """Log segments of the trees by round, and one row (tree, root) per tree."""

    rounds: list[DataFrame]
    roots: DataFrame


def leaf_digest(docs: DataFrame, **changed: Column) -> Column:
    """Digest of a row's fields: ``-`` for null, else the UTF-8 byte count, a colon and the value."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, docs[name]).cast("string")
        parts.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def grow(nodes: DataFrame, store: Store, name: str) -> Forest:
    """Trees over ``nodes`` (tree, rank, of, digest), built by rounds of aligned blocks."""
    nodes = nodes.select("tree", F.col("rank").alias("node"), "of", F.col("of").alias("leaves"), "digest")
    rounds: list[DataFrame] = []
    roots = None
    while True:
        level = BUILDER_LEVELS * len(rounds)
        blocks = nodes.withColumn("block", F.floor(F.col("node") / BLOCK))
        built = blocks.groupBy("tree", "block").applyInArrow(_builder(level), SEGMENT)
        built = store.keep(built, f"{name}-log-{len(rounds)}")
        rounds.append(built)
        done = built.filter(F.col("of") <= BLOCK).select("tree", F.col("top").alias("root"))
        roots = done if roots is None else roots.unionByName(done)
        above = built.filter(F.col("of") > BLOCK)
        if above.isEmpty():
            return Forest(rounds, roots)
        nodes = above.select("tree", F.col("block").alias("node"), F.ceil(F.col("of") / BLOCK).alias("of"), "leaves", F.col("top").alias("digest"))


def _builder(level: int):
    def build(block: pa.Table) -> pa.Table:
        """One aligned block of nodes: the log of their subtree."""
        block = block.sort_by("node")
        of = block["of"][0].as_py()
        log = append_log(block["digest"].to_pylist(), min(height(of), BUILDER_LEVELS))
        row = {c: block[c][:1] for c in ("tree", "block", "of", "leaves")}
        return pa.table(row | {"level": pa.array([level], pa.int32()), "digests": pa.array([log], pa.list_(pa.string())), "top": [log[-1]]})

    return build


def _unpacked(of: int, block: int) -> tuple[int, int]:
    """Leaves of a block, and levels that its builder added."""
    return min(BLOCK, of - block * BLOCK), min(height(of), BUILDER_LEVELS)


def _with_tops(segments: DataFrame, own: DataFrame, above: DataFrame | None) -> DataFrame:
    """Segments with the path of their top: the tree's own where the tree ends there, else that of a node one round above."""
    ended = segments.filter(F.col("of") <= BLOCK).join(own.select("tree", *ABOVE), "tree")
    if above is None:
        return ended
    going = segments.filter(F.col("of") > BLOCK).join(above.withColumnRenamed("node", "block"), ["tree", "block"])
    return ended.unionByName(going)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in batch.to_pylist():
            leaves, levels = _unpacked(s["of"], s["block"])
            found = [siblings(s["digests"], k, leaves, levels) for k in range(leaves)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([s["tree"]] * leaves),
                    pa.array(range(s["block"] * BLOCK, s["block"] * BLOCK + leaves), pa.int64()),
                    pa.array([f[0] + s["lefts"] for f in found], pa.list_(pa.string())),
                    pa.array([f[1] + s["rights"] for f in found], pa.list_(pa.string())),
                    pa.array([s["subroot"]] * leaves, pa.string()),
                    pa.array([s["root"]] * leaves, pa.string()),
                ],
                ["tree", "node", *ABOVE],
            )


def segments_with_paths(forest: Forest, own: DataFrame, store: Store, name: str) -> DataFrame:
    """The lowest segments with the path (lefts, rights) from their tops upward, and the roots that it leads to.

    ``own`` has the path above each tree's root (tree, lefts, rights, subroot, root). Rounds are read from the top: a
    segment's nodes get their siblings from the log by ``log_position`` and hand their paths down.
    """
    above = None
    for number in range(len(forest.rounds) - 1, 0, -1):
        placed = _with_tops(forest.rounds[number], own, above).select("tree", "block", "of", "digests", *ABOVE)
        above = store.keep(placed.mapInArrow(_paths, PATH), f"{name}-paths-{number}")
    return _with_tops(forest.rounds[0], own, above)


def log_nodes(forest: Forest) -> DataFrame:
    """The log as rows (tree, position, level, index, digest); positions are gapless from 0 in each tree."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                leaves, levels = _unpacked(s["of"], s["block"])
                whole, rows = height(s["leaves"]), []
                # Above the lowest round, a block's lowest nodes are tops that the round below has logged.
                width = leaves if s["level"] == 0 else -(-leaves // ARITY)
                for k in range(0 if s["level"] == 0 else 1, levels + 1):
                    first = s["block"] * ARITY ** (BUILDER_LEVELS - k)
                    for j in range(width):
                        level, index = s["level"] + k, first + j
                        rows.append((s["tree"], log_position(level, index, s["leaves"], whole), level, index, s["digests"][log_position(k, j, leaves, levels)]))
                    width = -(-width // ARITY)
                if rows:
                    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["tree", "position", "level", "index", "digest"])

    schema = "tree string, position long, level int, index long, digest string"
    logs = [r.mapInArrow(unfold, schema) for r in forest.rounds]
    whole = logs[0]
    for log in logs[1:]:
        whole = whole.unionByName(log)
    return whole


RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _verify(leaves: pa.Table, segment: pa.Table) -> pa.Table:
    """Proofs of a block's leaves against what they claim to be now."""
    s = segment.to_pylist()[0]
    count, levels = _unpacked(s["of"], s["block"])
    proofs, folded = [], []
    for node, claimed in zip(leaves["rank"].to_pylist(), leaves["claimed"].to_pylist()):
        left, right = siblings(s["digests"], node - s["block"] * BLOCK, count, levels)
        left, right = left + s["lefts"], right + s["rights"]
        proofs.append(digest([part for pair in zip(left, right) for part in pair]))
        folded.append(fold(claimed, left, right))
    rows = leaves.num_rows
    return pa.table(
        {
            "doc_id": leaves["doc_id"],
            "leaf": leaves["digest"],
            "subroot": [s["subroot"]] * rows,
            "root": [s["root"]] * rows,
            "proof_sha256": proofs,
            "folded_root": folded,
            "verified": [f == s["root"] for f in folded],
        }
    )


def tampered(docs: DataFrame) -> Column:
    """The text as an attacker leaves it: A-Z lower-cased in every third document by the CRC-32 of its id."""
    hit = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(hit, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))


class Manifest(NamedTuple):
    """Leaves (tree, doc_id, digest, claimed, rank, of), the trees of the languages, their ranked roots, and the tree over these."""

    leaves: DataFrame
    trees: Forest
    tops: DataFrame
    crown: Forest


def build_manifest(docs: DataFrame, claimed: Column, store: Store) -> Manifest:
    """The manifest of ``docs``; ``claimed`` is each document's text as it is presented for verification.

    Texts are hashed where they are read; only digests move. A tree is named by its language: empty for
    null, else ``=`` and the language.
    """
    tree = F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), "lang"))
    hashed = docs.select(
        tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf_digest(docs).alias("digest"), leaf_digest(docs, text=claimed).alias("claimed")
    )
    hashed = store.keep(hashed, "merkle-hashed")
    leaves = store.keep(rank_in_key(hashed, "tree", ["doc_id", "digest"], store, "merkle-ranged"), "merkle-leaves")
    trees = grow(leaves, store, "merkle-trees")
    named = trees.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    tops = store.keep(rank_in_key(named, "tree", ["name"], store, "merkle-top-ranges"), "merkle-tops")
    return Manifest(leaves, trees, tops, grow(tops, store, "merkle-crown"))


def verify_manifest(docs: DataFrame, store: Store) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of ``docs``.

    Per language, leaves ascend by doc_id (null first, then by digest, so rows with equal doc_id have one
    order); every eight consecutive nodes become one until one is left, and the languages' roots likewise.
    Aligned builders append their nodes to the log in completion order. A proof's siblings are addressed
    in the log by ``log_position``; the tampered (else original) leaf is folded with them and compared
    with the root.

    Null fields hash as ``-``; a null language is its own tree and comes first. Empty texts hash as ``0:``.
    Repeated rows are leaves of their own with equal digests. A lone leaf is its tree's root; without
    siblings the proof is the digest of nothing. An empty table gives no rows; other columns are not read.
    Texts of any length are hashed whole. No task holds more than a block of 512 nodes of a tree.
    """
    manifest = build_manifest(docs, tampered(docs), store)
    nothing = F.array().cast("array<string>")
    above = manifest.crown.roots.select("tree", nothing.alias("lefts"), nothing.alias("rights"), F.lit(None).cast("string").alias("subroot"), "root")
    crowned = segments_with_paths(manifest.crown, above, store, "merkle-crown").select("tree", "block", "of", "digests", *ABOVE)
    paths = crowned.mapInArrow(_paths, PATH).drop("subroot")
    tops = manifest.tops.select("tree", F.col("rank").alias("node"), "name", F.col("digest").alias("subroot"))
    own = store.keep(tops.join(paths, ["tree", "node"]).select(F.col("name").alias("tree"), *ABOVE), "merkle-own")
    segments = segments_with_paths(manifest.trees, own, store, "merkle-trees")
    blocks = manifest.leaves.withColumn("block", F.floor(F.col("rank") / BLOCK)).groupBy("tree", "block")
    return blocks.cogroup(segments.groupBy("tree", "block")).applyInArrow(_verify, RESULT)
