"""Links between near-equal embeddings by NN-descent."""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, cos, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm.components import components
from tradeflow.llm.storage import Store

LEAST_COSINE = 0.9
NEIGHBOURS = 8
TREES = 3
LEAF = 64
BLOCK = 256
LEVELS = 6
SETTLED = 0.03
#: Most neighbours of a list. Centres with more links than that are compared exactly, in regions around pivots.
LONGEST = 64
PIVOTS = 64
SIDE = 1024
AUDITED = 64
LEAST_RECALL = 0.99
AUDITS = 3
SLACK = 1e-7


def link_embeddings(embeddings: DataFrame, store: Store, least: float = LEAST_COSINE, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``embeddings``.

    Two vectors are linked when their cosine, in double precision, is at least ``least``. ``n_links`` counts
    the other vectors linked directly; ``component_id`` is the smallest id that links reach.

    Dense places are contracted first: a vector within half the link angle of a centre joins it, and all
    vectors of one centre are linked for certain, so a group of near copies of any size takes no pairs.
    NN-descent then builds the neighbour graph of the centres: lists start from random partitions, every
    centre introduces its neighbours to each other, and lists that are full of links are enlarged until
    their last entry is none. Edges within reach of the threshold are kept; where two centres' vectors
    may or may not be linked, they are compared in blocks. The vectors of centres whose list is still full
    of links at ``LONGEST`` entries are compared exactly with all that can be linked with them (``crowd_links``).
    A sample of vectors is audited against all rows; the descent is repeated from other partitions while
    recall is below ``LEAST_RECALL``, and after ``AUDITS`` times a recall below it is an error.

    A vector that is null, empty, zero, or holds null, NaN or infinity has no links and is its own
    component. Vectors of different length have no cosine and are not linked. Equal rows are vectors of
    their own that link with each other. An empty table gives no rows; other columns are not read.
    """
    rows = embeddings.select(F.col(key).alias("vec_id"), F.arrow_udf(_normalised, "array<double>")(F.col(vector).cast("array<double>")).alias("v"))
    rows = store.keep(rows.withColumn("uid", F.monotonically_increasing_id()), "link-vectors")
    vectors = rows.filter(F.col("v").isNotNull()).select("uid", "v")
    members, centres = contract(vectors, store, least)
    edges = crowded = None
    for turn in range(1, AUDITS + 1):
        fresh, full = descend(centres, store, least, turn)
        edges = fresh if edges is None else store.keep(edges.union(fresh).distinct(), f"link-edges-{turn}")
        crowded = full if crowded is None else store.keep(crowded.union(full).distinct(), f"link-crowded-{turn}")
        links, counts = _resolve(edges, crowded, centres, members, vectors, store, least, turn)
        recall = _audit(vectors, counts, least)
        if recall >= LEAST_RECALL:
            break
    else:
        raise RuntimeError(f"only {recall:.4f} of the audited links were found in {AUDITS} descents")
    found = components(links.select("u", "v"), store, "link-components")
    placed = members.join(found, members["centre"] == found["node"], "left").select(
        "uid", F.coalesce("component", "centre").alias("_group")
    )
    placed = store.keep(rows.select("uid", "vec_id").join(placed, "uid", "left").join(counts, "uid", "left"), "link-placed")
    names = placed.filter("_group IS NOT NULL").groupBy("_group").agg(F.min("vec_id").alias("_smallest"))
    return (
        placed.join(names, "_group", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("_smallest", "vec_id").alias("component_id"))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


def _normalised(column: pa.Array) -> pa.Array:
    """Unit vectors; null where there is none."""
    out = []
    for value in column.to_pylist():
        unit = None
        if value and None not in value:
            x = np.array(value, np.float64)
            top = np.abs(x).max()
            if np.isfinite(top) and top > 0:
                x = x / top
                unit = x / np.sqrt(x @ x)
        out.append(unit)
    return pa.array(out, pa.list_(pa.float64()))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _cell(seed: int, bits: int):
    """Number of the cell of a vector among ``bits`` random hyperplanes; its length is part of it."""

    def number(column: pa.Array) -> pa.Array:
        sizes = np.asarray(pa.compute.list_value_length(column))
        out = np.zeros(len(column), np.int64)
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            planes = np.random.default_rng([seed, int(size)]).standard_normal((int(size), bits))
            sides = _matrix(column.take(pa.array(own))) @ planes > 0
            out[own] = (sides @ (1 << np.arange(bits))) + (int(size) << 40)
        return pa.array(out)

    return number


def in_blocks(vectors: DataFrame, seed: int, rows: int) -> DataFrame:
    """``vectors`` with (cell, part): neighbours often share it, and it has about ``BLOCK`` rows or fewer."""
    bits = min(30, max(0, ceil(log2(max(rows, 1) / LEAF))))
    celled = vectors.withColumn("cell", F.arrow_udf(_cell(seed, bits), "long")("v"))
    parts = celled.groupBy(F.col("cell").alias("_cell")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_parts"))
    part = F.pmod(F.xxhash64("uid", F.lit(seed)), F.col("_parts"))
    placed = celled.join(parts, F.col("cell") == F.col("_cell")).withColumn("part", part).drop("_cell", "_parts")
    # The parts of a large cell go to different tasks.
    return placed.repartition("cell", "part")


def contract(vectors: DataFrame, store: Store, least: float) -> tuple[DataFrame, DataFrame]:
    """(uid, centre) of every vector, and the centres: uid, v, radius, texts.

    In each block the vectors, in the order of their ids, join the first centre near enough that
    everything joined stays within half the link angle. Levels go on over the centres, in other
    partitions, while any of them join.
    """
    reach = acos(least) / 2 - SLACK
    centres = vectors.withColumns({"radius": F.lit(0.0), "members": F.lit(1).cast("long")})
    members = vectors.select("uid", F.col("uid").alias("centre"))

    def join_near(block: pa.Table) -> pa.Table:
        order = np.argsort(block["uid"].to_numpy())
        ids, radius = block["uid"].to_numpy()[order], block["radius"].to_numpy()[order]
        v = _matrix(block["v"])[order]
        angle = np.arccos(np.clip(v @ v.T, -1.0, 1.0))
        angle[np.arange(len(ids)), np.arange(len(ids))] = 0.0
        to, away, leaders = np.arange(len(ids)), np.zeros(len(ids)), []
        for k in range(len(ids)):
            if leaders:
                near = angle[k, leaders] + radius[k] <= reach
                if near.any():
                    to[k] = leaders[int(np.argmax(near))]
                    away[k] = angle[k, to[k]]
                    continue
            leaders.append(k)
        return pa.table({"uid": ids, "to": ids[to], "away": away + radius})

    for level in range(1, LEVELS + 1):
        rows = centres.count()
        joined = in_blocks(centres, 100 + level, rows).groupBy("cell", "part").applyInArrow(join_near, "uid long, to long, away double")
        joined = store.keep(joined, f"link-level-{level}")
        if joined.filter("uid <> to").isEmpty():
            break
        sizes = joined.join(centres.select("uid", "members"), "uid").groupBy("to").agg(F.max("away").alias("radius"), F.sum("members").alias("members"))
        leaders = centres.select("uid", "v").join(sizes, F.col("uid") == F.col("to")).select("uid", "v", "radius", "members")
        centres = store.keep(leaders, f"link-centres-{level}")
        moved = joined.select(F.col("uid").alias("_from"), "to")
        members = store.keep(members.join(moved, F.col("centre") == F.col("_from")).select("uid", F.col("to").alias("centre")), f"link-members-{level}")
    return members, centres


def descend(centres: DataFrame, store: Store, least: float, turn: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of centres (u, w, cosine) that may hold links, from the neighbour graph NN-descent finds, and the
    centres (uid) whose list is too short for them."""
    rows = centres.count()
    widest = centres.agg(F.coalesce(F.max("radius"), F.lit(0.0))).first()[0]
    reach = cos(min(np.pi, acos(least) + 2 * widest + SLACK))
    items = centres.select("uid", "v")
    limits = items.select("uid", F.lit(NEIGHBOURS).alias("limit"))
    graph = None
    for tree in range(TREES):
        first = in_blocks(items, 1000 * turn + tree, rows).groupBy("cell", "part").applyInArrow(_nearest_in_block, "u long, w long, cosine double")
        graph = first if graph is None else graph.union(first)
    graph = store.keep(_trimmed(graph, limits), f"link-graph-{turn}-0")
    step = 0
    while True:
        step += 1
        # Full lists whose last entry may still hold links get twice the room, up to the longest.
        full = graph.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("cosine").alias("last"))
        room = limits.join(full, limits["uid"] == full["u"], "left").select(
            "uid",
            "limit",
            F.coalesce((F.col("n") >= F.col("limit")) & (F.col("last") >= reach), F.lit(False)).alias("saturated"),
            F.when(F.col("n") >= F.col("limit"), F.col("last")).otherwise(-2.0).alias("last"),
        )
        room = store.keep(room, f"link-room-{turn}-{step}")
        grows = F.col("saturated") & (F.col("limit") < LONGEST)
        growing = not room.filter(grows).isEmpty()
        limits = room.select("uid", F.when(grows, F.col("limit") * 2).otherwise(F.col("limit")).alias("limit"))
        bar = F.when(grows, F.lit(-2.0)).otherwise(F.col("last")).alias("bar")
        introduced = _introduce(graph, items.join(room.select("uid", bar), "uid"), rows)
        introduced = store.keep(introduced.join(graph.select("u", "w"), ["u", "w"], "left_anti").distinct(), f"link-met-{turn}-{step}")
        met = introduced.count()
        graph = store.keep(_trimmed(graph.union(introduced.select("u", "w", "cosine")), limits), f"link-graph-{turn}-{step}")
        if not growing and met <= SETTLED * NEIGHBOURS * rows:
            break
    near = graph.filter(F.col("cosine") >= reach)
    crowded = store.keep(near.groupBy(F.col("u").alias("uid")).count().filter(F.col("count") >= LONGEST).select("uid"), f"link-full-{turn}")
    near = store.keep(near.select(F.least("u", "w").alias("u"), F.greatest("u", "w").alias("w"), "cosine").dropDuplicates(["u", "w"]), f"link-near-{turn}")
    return near, crowded


def _trimmed(graph: DataFrame, limits: DataFrame) -> DataFrame:
    """The nearest entries of every list, as many as it has room for."""
    ranked = graph.dropDuplicates(["u", "w"]).withColumn("_rank", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("cosine"), "w")))
    return ranked.join(limits, ranked["u"] == limits["uid"]).filter(F.col("_rank") <= F.col("limit")).select("u", "w", "cosine")


def _nearest_in_block(block: pa.Table) -> pa.Table:
    ids, v = block["uid"].to_numpy(), _matrix(block["v"])
    cosine = v @ v.T
    np.fill_diagonal(cosine, -np.inf)
    k = min(NEIGHBOURS, len(ids) - 1)
    best = np.argpartition(-cosine, max(k - 1, 0), axis=1)[:, :k]
    u = np.repeat(np.arange(len(ids)), k)
    return pa.table({"u": ids[u], "w": ids[best.ravel()], "cosine": cosine[u, best.ravel()]})


def _introduce(graph: DataFrame, items: DataFrame, rows: int) -> DataFrame:
    """Cosines of all pairs that one centre knows, where they would enter a list.

    A centre knows its list and, of those that list it, as many as a list has room for at first.
    """
    back = graph.select(F.col("w").alias("u"), F.col("u").alias("w"))
    turn = F.row_number().over(Window.partitionBy("u").orderBy(F.xxhash64("u", "w")))
    back = back.withColumn("_turn", turn).filter(F.col("_turn") <= NEIGHBOURS).drop("_turn")
    known = graph.select("u", "w").union(back).distinct()
    blocks = max(1, ceil(rows / 2000))
    met = known.join(items, known["w"] == items["uid"]).select("u", "w", "v", "bar", F.pmod(F.xxhash64("u"), F.lit(blocks)).alias("block"))

    def introduce(block: pa.Table) -> pa.Table:
        hosts = block["u"].to_numpy()
        order = np.argsort(hosts, kind="stable")
        guests, bar, v = block["w"].to_numpy()[order], block["bar"].to_numpy()[order], _matrix_of_equal(block["v"], order)
        cuts = np.flatnonzero(np.diff(hosts[order])) + 1
        u, w, cosine = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for own in np.split(np.arange(len(guests)), cuts):
            for same in _by_length(v, own):
                found = np.stack([v[k] for k in same])
                found = found @ found.T
                np.fill_diagonal(found, -np.inf)
                a, b = np.nonzero(found > bar[same][:, None])
                u.append(guests[same[a]])
                w.append(guests[same[b]])
                cosine.append(found[a, b])
        return pa.table({"u": np.concatenate(u), "w": np.concatenate(w), "cosine": np.concatenate(cosine)})

    return met.groupBy("block").applyInArrow(introduce, "u long, w long, cosine double")


def _matrix_of_equal(column: pa.ChunkedArray, order: np.ndarray) -> list[np.ndarray] | np.ndarray:
    """Vectors in an order: a matrix where all have one length."""
    column = column.combine_chunks()
    sizes = np.asarray(pa.compute.list_value_length(column))
    if len(np.unique(sizes)) <= 1:
        return _matrix(column)[order]
    return [np.array(column[int(k)].as_py()) for k in order]


def _by_length(v: list[np.ndarray] | np.ndarray, own: np.ndarray) -> Iterator[np.ndarray]:
    if isinstance(v, np.ndarray):
        yield own
        return
    sizes = np.array([len(v[k]) for k in own])
    for size in np.unique(sizes):
        yield own[sizes == size]


def crowd_links(crowd: DataFrame, vectors: DataFrame, store: Store, least: float, turn: int) -> DataFrame:
    """(uid, n, to): the links between the vectors of ``crowd`` (uid) and all ``vectors``, counted exactly.

    Every vector of the crowd belongs to the region of its nearest pivot, out of a bounded sample of the crowd.
    A vector that is linked with one of a region is no further from the pivot than the region's radius and the
    link angle, so those that are further are left out for certain. A region is compared in blocks of bounded
    size. No pairs leave a block: per vector of the crowd the number of its links with others there, per other
    vector the number of its links with the crowd, and the smallest vector that links in the block lead to.
    """
    marked = vectors.join(crowd.withColumn("crowded", F.lit(True)), "uid", "left").withColumn("crowded", F.coalesce("crowded", F.lit(False)))
    marked = store.keep(marked, f"link-marked-{turn}")
    sample = marked.filter("crowded").orderBy(F.xxhash64("uid")).limit(PIVOTS).collect()
    sizes = {len(r["v"]) for r in sample}
    pivots = {size: np.array([r["v"] for r in sample if len(r["v"]) == size]) for size in sizes}

    def angles(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, rows, angles to the pivots of that length); without pivots all are at 0 from one region."""
        lengths = np.asarray(pa.compute.list_value_length(column))
        for size in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == size)
            v = _matrix(column.take(pa.array(own)))
            near = np.arccos(np.clip(v @ pivots[size].T, -1.0, 1.0)) if size in pivots else np.zeros((len(own), 1))
            yield size, own, near

    @F.arrow_udf("size int, pivot int, angle double")
    def nearest(column: pa.Array) -> pa.Array:
        out = np.zeros((3, len(column)))
        for size, own, near in angles(column):
            out[0, own], out[1, own], out[2, own] = size, near.argmin(axis=1), near.min(axis=1)
        return pa.StructArray.from_arrays([pa.array(out[0].astype(np.int32)), pa.array(out[1].astype(np.int32)), pa.array(out[2])], ["size", "pivot", "angle"])

    placed = marked.filter("crowded").select("uid", "v", nearest("v").alias("r")).select("uid", "v", "r.*")
    placed = store.keep(placed, f"link-regions-{turn}")
    # At most PIVOTS regions, and one per length of vectors without a pivot.
    radius = {(r["size"], r["pivot"]): r["radius"] for r in placed.groupBy("size", "pivot").agg(F.max("angle").alias("radius")).collect()}
    reach = acos(least) + 2 * SLACK

    @F.arrow_udf("array<struct<size: int, pivot: int>>")
    def regions(column: pa.Array) -> pa.Array:
        found: list[list[dict[str, int]]] = [[] for _ in range(len(column))]
        for size, own, near in angles(column):
            for pivot in range(near.shape[1]):
                if (size, pivot) in radius:
                    for k in own[near[:, pivot] <= radius[size, pivot] + reach].tolist():
                        found[k].append({"size": size, "pivot": pivot})
        return pa.array(found, pa.list_(pa.struct([("size", pa.int32()), ("pivot", pa.int32())])))

    around = marked.select("uid", "v", "crowded", F.explode(regions("v")).alias("r")).select("uid", "v", "crowded", "r.*")
    around = store.keep(around, f"link-around-{turn}")
    parts = lambda df, name: df.groupBy("size", "pivot").agg(F.ceil(F.count(F.lit(1)) / SIDE).cast("int").alias(name))
    shape = F.broadcast(parts(placed, "inner").join(parts(around, "outer"), ["size", "pivot"]))
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = lambda n: F.pmod(F.xxhash64("uid"), n).cast("int")
    left = placed.join(shape, ["size", "pivot"]).select("size", "pivot", "uid", "v", F.lit(True).alias("crowded"), F.lit(True).alias("left"), dealt("inner").alias("p"), all_of("outer").alias("t"))
    right = around.join(shape, ["size", "pivot"]).select("size", "pivot", "uid", "v", "crowded", F.lit(False).alias("left"), dealt("outer").alias("t"), all_of("inner").alias("p"))
    done = left.unionByName(right).groupBy("size", "pivot", "p", "t").applyInArrow(_crowd_block(least), "uid long, n long, to long")
    return store.keep(done, f"link-crowd-{turn}")


def _crowd_block(least: float):
    def count(block: pa.Table) -> pa.Table:
        side, crowded = np.asarray(block["left"]), np.asarray(block["crowded"])
        ids, v = block["uid"].to_numpy(), _matrix(block["v"])
        a, b, others = ids[side], ids[~side], ~crowded[~side]
        linked = (v[side] @ v[~side].T >= least) & (a[:, None] != b[None, :])
        every, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        # The smallest number reachable within the block, by passing smaller ones along until none moves.
        to, pairs = np.arange(len(every)), np.nonzero(linked)
        x, y = at[: len(a)][pairs[0]], at[len(a) :][pairs[1]]
        while True:
            low = to.copy()
            np.minimum.at(low, x, to[y])
            np.minimum.at(low, y, to[x])
            low = low[low]
            if np.array_equal(low, to):
                break
            to = low
        uid = np.concatenate([a, b[others]])
        n = np.concatenate([linked.sum(axis=1), linked[:, others].sum(axis=0)])
        return pa.table({"uid": np.concatenate([uid, b[~others]]), "n": np.concatenate([n, np.zeros((~others).sum(), np.int64)]), "to": every[to[np.concatenate([at[: len(a)], at[len(a) :][others], at[len(a) :][~others]])]]})

    return count


def _resolve(
    edges: DataFrame, crowded: DataFrame, centres: DataFrame, members: DataFrame, vectors: DataFrame, store: Store, least: float, turn: int
) -> tuple[DataFrame, DataFrame]:
    """Linked pairs of centres (u, v), and (uid, n_links) of every vector."""
    if crowded.isEmpty():
        return _resolve_edges(edges, centres, members, vectors, store, least, turn)
    # Whatever touches a crowded centre is counted exactly, so edges of such a centre are left to that.
    crowd = members.join(crowded.withColumnRenamed("uid", "centre"), "centre", "left_semi").select("uid")
    crowd = store.keep(crowd, f"link-crowd-uids-{turn}")
    found = crowd_links(crowd, vectors, store, least, turn)
    for end in ("u", "w"):
        edges = edges.join(crowded.withColumnRenamed("uid", end), end, "left_anti")
    links, counts = _resolve_edges(edges.select("u", "w", "cosine"), centres, members, vectors, store, least, turn)
    exact = found.groupBy("uid").agg(F.sum("n").alias("exact")).join(crowd.withColumn("inside", F.lit(True)), "uid", "left")
    total = F.when(F.col("inside"), F.col("exact")).otherwise(F.col("n_links") + F.coalesce("exact", F.lit(0)))
    counts = store.keep(counts.join(exact, "uid", "left").select("uid", total.alias("n_links")), f"link-all-counts-{turn}")
    ends = found.filter("uid <> to").select("uid", "to").distinct()
    a, b = members.select("uid", F.col("centre").alias("u")), members.select(F.col("uid").alias("to"), F.col("centre").alias("v"))
    joined = ends.join(a, "uid").join(b, "to").select("u", "v").filter("u <> v")
    return store.keep(links.unionByName(joined).distinct(), f"link-all-links-{turn}"), counts


def _resolve_edges(
    edges: DataFrame, centres: DataFrame, members: DataFrame, vectors: DataFrame, store: Store, least: float, turn: int
) -> tuple[DataFrame, DataFrame]:
    a = centres.select(F.col("uid").alias("u"), F.col("radius").alias("ru"), F.col("members").alias("nu"))
    b = centres.select(F.col("uid").alias("w"), F.col("radius").alias("rw"), F.col("members").alias("nw"))
    spread = F.col("ru") + F.col("rw")
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "cosine")))
    single = spread == 0
    certain = (single & (F.col("cosine") >= least)) | (~single & (angle + spread <= acos(least) - SLACK))
    possible = ~certain & ~single & (angle - spread <= acos(least) + SLACK)
    state = edges.join(a, "u").join(b, "w").select("u", "w", "nu", "nw", certain.alias("certain"), possible.alias("possible"))
    state = store.keep(state, f"link-state-{turn}")
    sure = state.filter("certain")
    by_centre = sure.select(F.col("u").alias("centre"), F.col("nw").alias("n")).union(sure.select("w", "nu"))
    by_centre = by_centre.groupBy("centre").agg(F.sum("n").alias("others"))
    compared = _compare(state.filter("possible"), members, vectors, store, least, turn)
    own = centres.select(F.col("uid").alias("centre"), (F.col("members") - 1).alias("mates"))
    totals = own.join(by_centre, "centre", "left")
    counts = (
        members.join(totals, "centre")
        .join(compared.groupBy("uid").agg(F.sum("n").alias("more")), "uid", "left")
        .select("uid", (F.col("mates") + F.coalesce("others", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_links"))
    )
    links = sure.select("u", F.col("w").alias("v")).union(compared.select("u", "v")).distinct()
    return links, store.keep(counts, f"link-counts-{turn}")


def _compare(possible: DataFrame, members: DataFrame, vectors: DataFrame, store: Store, least: float, turn: int) -> DataFrame:
    """(u, v, uid, n): links of a vector of centre u or v with vectors of the other, in blocks of bounded size."""
    parts_u, parts_w = F.ceil(F.col("nu") / BLOCK).cast("int"), F.ceil(F.col("nw") / BLOCK).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    dealt = lambda n: F.pmod(F.xxhash64("uid"), n).cast("int")
    full = members.join(vectors, "uid")
    left = possible.join(full, F.col("u") == F.col("centre")).select("u", "w", "uid", "v", F.lit(True).alias("left"), dealt(parts_u).alias("p"), all_of(parts_w).alias("t"))
    right = possible.join(full, F.col("w") == F.col("centre")).select("u", "w", "uid", "v", F.lit(False).alias("left"), dealt(parts_w).alias("t"), all_of(parts_u).alias("p"))

    def count(block: pa.Table) -> pa.Table:
        side = np.asarray(block["left"])
        ids, v = block["uid"].to_numpy(), _matrix(block["v"])
        linked = v[side] @ v[~side].T >= least
        n = np.concatenate([linked.sum(axis=1), linked.sum(axis=0)])
        every = np.concatenate([ids[side], ids[~side]])
        u, w = block["u"][0].as_py(), block["w"][0].as_py()
        has = n > 0
        return pa.table({"u": np.full(has.sum(), u), "v": np.full(has.sum(), w), "uid": every[has], "n": n[has]})

    done = left.unionByName(right).groupBy("u", "w", "p", "t").applyInArrow(count, "u long, v long, uid long, n long")
    return store.keep(done, f"link-compared-{turn}")


def _audit(vectors: DataFrame, counts: DataFrame, least: float) -> float:
    """Share of the links of ``AUDITED`` vectors that are counted, all rows compared with each of them."""
    sample = vectors.orderBy(F.xxhash64("uid")).limit(AUDITED).collect()
    if not sample:
        return 1.0
    wanted: dict[int, list[int]] = {}
    for k, row in enumerate(sample):
        wanted.setdefault(len(row["v"]), []).append(k)
    known = {size: (np.array(ks), np.array([sample[k]["v"] for k in ks])) for size, ks in wanted.items()}

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sample), np.int64)
        for batch in batches:
            sizes = np.asarray(pa.compute.list_value_length(batch.column(0)))
            for size, (ks, queries) in known.items():
                own = np.flatnonzero(sizes == size)
                if len(own):
                    total[ks] += (_matrix(batch.column(0).take(pa.array(own))) @ queries.T >= least).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sample))), pa.array(total)], ["k", "n"])

    found = vectors.select("v").mapInArrow(near, "k long, n long").groupBy("k").agg(F.sum("n")).collect()
    expected = sum(n for _, n in found) - len(sample)
    got = counts.filter(F.col("uid").isin([r["uid"] for r in sample])).agg(F.sum("n_links")).first()[0]
    return got / expected if expected > 0 else 1.0
