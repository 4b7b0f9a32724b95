"""The Merkle manifest against a plain tree, and the postorder log against its closed form."""

import zlib
from hashlib import sha256

import pytest
from tradeflow.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, root string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + 8]) for k in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, index):
    for nodes in levels[:-1]:
        first = index - index % 8
        yield nodes[first:index], nodes[index + 1 : first + 8]
        index //= 8


def expected(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang, own in by_lang.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[lang] = levels_of([leaf_of(r) for r in own])
    if not langs:
        return []
    crown = levels_of([trees[lang][-1][0] for lang in langs])
    root, out = crown[-1][0], []
    for number, lang in enumerate(langs):
        for index, row in enumerate(by_lang[lang]):
            sides = [*path(trees[lang], index), *path(crown, number)]
            text = row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf_of((*row[:4], text))
            for left, right in sides:
                folded = h(*left, folded, *right)
            proof = h(*(d for left, right in sides for d in (*left, *right)))
            out.append((row[0], leaf_of(row), trees[lang][-1][0], root, proof, folded, folded == root))
    return out


def key(row):
    return tuple((v is None, v) for v in row)


ROWS = [
    *[(k, f"s{k % 3}", "en", k * 7, f"Text Number {k} Ä") for k in range(1300, 0, -1)],
    *[(k, "s", "de", None, "kein Wort" * (k % 50)) for k in range(2000, 2070)],
    (5, None, None, None, None), (6, "", None, 0, ""), (3, "x", "fr", 1, "ALONE"), (None, "n", "es", 1, "No Id"), (None, "n", "es", 2, "No Id"),
    (9, "t", "es", 1, "Twice"), (9, "t", "es", 1, "Twice"), (9, "t", "es", 1, "Another"), (12, "l", "es", 1, "LONG " * 100_000),
    *[(3000 + k, "q", f"x{k:02d}é", 1, "Many Languages") for k in range(12)],
]


def test_manifest_agrees_with_a_plain_tree(spark, checkpoint_store):
    docs = spark.createDataFrame([(*r, "l", "r") for r in ROWS], SCHEMA).repartition(5)
    got = [tuple(r) for r in merkle.verify_manifest(docs, checkpoint_store).collect()]
    assert sorted(got, key=key) == sorted(expected(list(ROWS)), key=key)
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("rows", [[], ROWS[-3:-2], [ROWS[0]] * 9])
def test_small_tables(spark, checkpoint_store, rows):
    docs = spark.createDataFrame([(*r, "l", "r") for r in rows], SCHEMA)
    got = [tuple(r) for r in merkle.verify_manifest(docs, checkpoint_store).collect()]
    assert sorted(got) == sorted(expected(list(rows)))


@pytest.mark.parametrize("n", [1, 2, 8, 9, 63, 64, 65, 80, 511, 512])
def test_positions_in_the_log_follow_from_numbers_alone(n):
    leaves = [h(str(k)) for k in range(n)]
    levels, height = levels_of(leaves), merkle.height(n)
    log = merkle.append_log(leaves, height)
    assert len(levels) == height + 1 and len(log) == sum(map(len, levels)) and log[-1] == levels[-1][0]
    for level, nodes in enumerate(levels):
        for index, digest in enumerate(nodes):
            assert log[merkle.log_position(level, index, n, height)] == digest
    for index in range(n):
        left, right = merkle.siblings(log, index, n, height)
        assert merkle.fold(leaves[index], left, right) == log[-1]
        assert left == ["".join(x) for x, _ in path(levels, index)]


def test_the_whole_log_is_gapless_and_in_postorder(spark, checkpoint_store):
    docs = spark.createDataFrame([(*r, "l", "r") for r in ROWS], SCHEMA)
    manifest = merkle.build_manifest(docs, docs["text"], checkpoint_store)
    trees = {}
    for r in merkle.log_nodes(manifest.trees).collect():
        trees.setdefault(r.tree, {})[r.position] = (r["level"], r["index"], r["digest"])
    assert len(trees) == 17 and len(trees["=en"]) == 1300 + 163 + 21 + 3 + 1
    for nodes in trees.values():
        assert sorted(nodes) == list(range(len(nodes)))
        done = {}
        for position in range(len(nodes)):
            level, index, digest = nodes[position]
            children = [done[level - 1, k] for k in range(8 * index, 8 * index + 8) if (level - 1, k) in done] if level else []
            assert digest == (h(*children) if level else digest)
            done[level, index] = digest
