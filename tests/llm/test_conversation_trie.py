"""The prefix trie and its contraction against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import md5, sha256

import pytest
from pyspark.sql import functions as F
from tradeflow.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int"
WORD = re.compile(ct.WORD)


def expected(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs[conv].append((turn is not None, turn or 0, name, role, text))
    turns = {c: [t[3:] for t in sorted(own)] for c, own in convs.items()}
    built = {}
    for c in turns:
        heads = zlib.crc32(str(c).encode()) % 4
        first = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = tuple(turns.get(first, [])[:heads] + turns[c][heads:])
    members = defaultdict(list)
    for c, own in built.items():
        for d in range(len(own) + 1):
            members[own[:d]].append(c)
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    out, totals = [], {}
    for prefix in sorted(members, key=len, reverse=True):
        words = len(WORD.findall(prefix[-1][1])) if prefix else 0
        leaves = sum(totals[p][0] for p in children[prefix]) or 1
        saved = (len(members[prefix]) - 1) * words + sum(totals[p][1] for p in children[prefix])
        totals[prefix] = leaves, saved
        ended = sorted(c for c in members[prefix] if len(built[c]) == len(prefix))
        out.append(
            (
                min(members[prefix]), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(members[prefix]), len(children[prefix]),
                leaves, saved, sha256(",".join(map(str, ended)).encode()).hexdigest(),
            )
        )
    return out


def key(row):
    return tuple((v is None, v) for v in row)


def drawn(seed):
    draw = random.Random(seed)
    turns = [("user", "Hello there"), ("user", "Hi"), ("assistant", "a b  c\n"), (None, "x"), ("user", None), ("a", "b c"), ("ab", " c")]
    rows = [(c, t, *draw.choice(turns)) for c in range(-25, 90) for t in range(draw.randint(1, 6))]
    rows += [(100, 0, "user", "only")] * 3 + [(101, None, "user", "n"), (101, 3, "user", "m"), (102, 1, "b", "tie"), (102, 1, "a", "tie")]
    return rows + [(None, 0, "user", "lost"), (7, 9, "user", "y " * 50_000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_agrees_with_brute_force(spark, checkpoint_store, seed):
    rows = drawn(seed)
    frame = spark.createDataFrame([(*r, "n", 1) for r in rows], SCHEMA).repartition(4)
    got = ct.conversation_trie(frame, checkpoint_store)
    assert set(dict(got.drop("ends_sha256").dtypes).values()) == {"bigint"}
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(expected(rows), key=key)


def test_one_conversation_holds_most_rows(spark, checkpoint_store):
    """400 turns in one conversation: compress has to shorten the chain, as rake alone takes one turn a round."""
    rows = [(40, t, "user", f"turn {t % 3}") for t in range(400)] + [(c, t, "user", f"turn {t}") for c in range(41, 60) for t in range(3)]
    frame = spark.createDataFrame([(*r, "n", 1) for r in rows], SCHEMA).repartition(4)
    got = ct.conversation_trie(frame, checkpoint_store).collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted(expected(rows), key=key)


def test_no_conversations(spark, checkpoint_store):
    for rows in ([], [(None, 1, "user", "x", "n", 1)]):
        assert ct.conversation_trie(spark.createDataFrame(rows, SCHEMA), checkpoint_store).count() == 0


@pytest.mark.parametrize("shape", ["chain", "star", "random", "forest"])
def test_contraction_gives_every_subtree_total(spark, checkpoint_store, shape):
    draw, n = random.Random(4), 120
    parent = {
        "chain": [k - 1 if k else None for k in range(n)],
        "star": [0 if k else None for k in range(n)],
        "random": [draw.randrange(max(0, k - 4), k) if k else None for k in range(n)],
        "forest": [None if k % 40 == 0 else draw.randrange(k - k % 40, k) for k in range(n)],
    }[shape]
    weight = [draw.randint(0, 9) for _ in range(n)]
    total = list(weight)
    for k in range(n - 1, 0, -1):
        if parent[k] is not None:
            total[parent[k]] += total[k]
    kids = Counter(parent)
    name = lambda k: None if k is None else f"n{k}"
    tree = spark.createDataFrame([(name(k), name(parent[k]), kids[k], weight[k]) for k in range(n)], "node string, parent string, children long, saved long")
    got = ct.subtree_totals(tree, checkpoint_store, ("saved",), name=f"contract-{shape}")
    assert {r.node: r.saved for r in got.collect()} == {name(k): total[k] for k in range(n)}


def test_ends_are_hashed_over_ranges(spark, checkpoint_store):
    enders = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id") % 60)).alias("node"), "id").withColumnRenamed("id", "conv_id")
    want = defaultdict(list)
    for k in range(5000):
        want["hot" if k % 3 else f"n{k % 60}"].append(str(k))
    got = {r.node: r.ends_sha256 for r in ct._ends(enders, checkpoint_store).collect()}
    assert got == {node: sha256(",".join(ids).encode()).hexdigest() for node, ids in want.items()}
