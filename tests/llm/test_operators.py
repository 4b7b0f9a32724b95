"""Operators against brute force on small tables with nulls, ties, copies, clashing names and no rows."""

import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tradeflow.llm.embedding_links import link_embeddings
from tradeflow.llm.language import identify_languages, learn_dictionaries
from tradeflow.llm.licenses import LEAST_DICE, TEMPLATES, anchors, scan_licenses, template_words
from tradeflow.llm.mixing import mix_sources, mixed_documents
from tradeflow.llm.near_duplicates import distinct_documents, near_duplicate_classes
from tradeflow.llm.quality import judge_quality
from tradeflow.llm.sharding import shard_by_bytes
from tradeflow.llm.url_filter import judge_urls, propagate

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _quality string, _copy string"


@pytest.fixture(scope="module")
def rows(spark):
    """Given documents, then: null and empty texts, equal rows, a null id, a long text."""
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    rows = [(r.doc_id, r.text, r.lang, r.source, 0, "q", "c") for r in given]
    extra = [(9001, None, None, None), (9002, "", "en", "s"), (9003, "| 12 |", "en", "s"), (None, "no id at all", "en", "s")]
    extra += [(9004, "same same", "en", "s")] * 2 + [(9005, given[0].text * 40, "fr", None)]
    return rows + [(*e, 0, "q", "c") for e in extra]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(4)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_shards(docs, rows, empty, checkpoint_store):
    got = shard_by_bytes(docs, checkpoint_store).collect()
    sizes = [len((r[1] or "").encode()) + 1 for r in rows]
    assert sorted(r.size for r in got) == sorted(sizes)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 8
    for shard in range(8):
        own = [r for r in got if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - sum(sizes) / 8) <= max(sizes)
    assert shard_by_bytes(empty, checkpoint_store).count() == 0


def test_mix(docs, rows, empty, checkpoint_store):
    got = mix_sources(docs, checkpoint_store).collect()
    assert sorted(r.size for r in got) == sorted(len(WORD.findall(r[1] or "")) for r in rows)
    total = sum(r.size for r in got)
    assert total * 1.5 - max(r.size for r in got) <= sum(r.taken for r in got) <= total * 1.5
    assert all(r.taken in (0, r.size, 2 * r.size) for r in got)
    by_source = defaultdict(list)
    for r in got:
        by_source[r.source].append(r)
    for own in by_source.values():
        assert own[0].target <= 2 * sum(r.size for r in own) + 1e-6
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2 * max(r.size for r in own) + 1
    assert mix_sources(empty, checkpoint_store).count() == 0
    mixed = mixed_documents(docs, checkpoint_store)
    assert mixed.columns == docs.columns
    assert {r["_copy"] for r in mixed.select("_copy").distinct().collect()} == {"c"}
    assert mixed_documents(empty, checkpoint_store).count() == 0


@pytest.mark.parametrize("percent", [60, 150, 200])
def test_mixed_documents_are_the_copies_of_the_mix(spark, checkpoint_store, percent):
    """Unique ids, several sources, and documents without words."""
    texts = [" ".join(["w"] * (n % 7)) if n % 11 else None for n in range(300)]
    table = [(n, texts[n], None if n % 5 == 0 else f"s{n % 3}") for n in range(300)]
    docs = spark.createDataFrame([(None, "a b", "s1"), *table], "doc_id long, text string, source string")
    planned = {(r.doc_id, r.source): r.copies for r in mix_sources(docs, checkpoint_store, budget_percent=percent).collect() if r.copies}
    mixed = Counter((r.doc_id, r.source) for r in mixed_documents(docs, checkpoint_store, budget_percent=percent).collect())
    assert mixed == planned


def test_near_duplicates(docs, rows, empty, checkpoint_store):
    sets = [(r[0], frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))) for r in rows if r[0] is not None and (w := WORD.findall(r[1] or ""))]
    top = {r[0]: r[0] for r in rows}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for (i, a), (j, b) in combinations(sets, 2):
        if len(a & b) >= 0.8 * len(a | b):
            low, high = sorted((root(i), root(j)))
            top[high] = low
    got = near_duplicate_classes(docs, checkpoint_store).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.class_id for r in got} == {i: (root(i) if i is not None else None) for i in top}
    kept = distinct_documents(docs, checkpoint_store)
    assert kept.columns == docs.columns
    assert Counter(r[0] for r in kept.select("doc_id").collect()) == Counter({i for i in top if i is None or root(i) == i})
    assert near_duplicate_classes(empty, checkpoint_store).count() == 0


def test_quality(spark, docs, rows, empty):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = judge_quality(docs, labels).collect()
    expected = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        often = {w for w, n in Counter(windows).items() if n > 1}
        covered = {k + i for k, w in enumerate(windows) if w in often for i in range(8)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        expected.append((doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(expected, key=key)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert judge_quality(empty, labels.limit(0)).count() == 0


def test_languages(docs, rows, empty):
    got = identify_languages(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[9001].lang_pred == by_id[9002].lang_pred == by_id[9003].lang_pred == "und"
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert all(0 <= r.score <= 1 for r in got)
    truth = {r[0]: r[2] for r in rows if r[0] is not None and r[0] < 9000}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.9 * len(held)
    assert identify_languages(empty).count() == 0


MIT_OPENING = TEMPLATES["MIT"][1]
BSD_2, BSD_3 = TEMPLATES["BSD-2-Clause"][0], TEMPLATES["BSD-3-Clause"][1]


def test_licences(spark, empty):
    cases = [
        ("x\nReleased under the MIT License.\ny", "MIT", "MIT", 1.0),
        ("RELEASED under the mit license", "MIT", "MIT", 1.0),
        ("Licensed under CC BY-NC 4.0.\nReleased under the MIT License.", "CC-BY-NC-4.0;MIT", "CC-BY-NC-4.0", 1.0),
        ("Copyright 2024 Foo. Released under the MIT License.", "MIT", "MIT", 1.0),
        ("Released under the MIT License. See the LICENSE file.", "MIT", "MIT", 1.0),
        (MIT_OPENING + ", and so on", "MIT", "MIT", 1.0),
        ("# This work is licensed under the GNU General\n# Public License, version 3.", "GPL-3.0", "GPL-3.0", 1.0),
        ("Copyright 2020\n" + "\n".join("// " + line for line in BSD_3.split("\n")), "BSD-3-Clause", "BSD-3-Clause", 1.0),
        (BSD_2, "BSD-2-Clause", "BSD-2-Clause", 1.0),
        # Very long, with a notice at its very end; repeated notices; words of a notice out of order.
        ("plain words " * 200_000 + "licensed under cc by-sa 4.0", "CC-BY-SA-4.0", "CC-BY-SA-4.0", 1.0),
        ("Released under the MIT License.\n" * 50, "MIT", "MIT", 1.0),
        ("license the under released MIT", "", None, None),
        ("the", "", None, None),
        ("", "", None, None),
        (None, "", None, None),
    ]
    rows = [(k, c[0], "extra") for k, c in enumerate(cases)]
    docs = spark.createDataFrame(rows + rows[:1] + [(None, cases[0][0], "")], "doc_id long, text string, _words string")
    got = scan_licenses(docs).collect()
    by_id = {r.doc_id: (r.licenses, r.best_license, r.best_dice) for r in got}
    assert [by_id[k] for k in range(len(cases))] == [c[1:] for c in cases]
    assert len(got) == len(cases) + 2 and by_id[None] == by_id[0]
    assert scan_licenses(empty).count() == 0
    assert {(r.licenses, r.best_license, r.best_dice) for r in scan_licenses(docs, {}).collect()} == {("", None, None)}


def test_edited_licence_texts_against_brute_force(spark):
    """Words dropped, changed and added at random: every aligned window of every template, without anchors or bounds on size."""
    draw = np.random.default_rng(11)
    known = [(n, w) for n, ws in sorted(TEMPLATES.items()) for w in map(template_words, ws)]
    rows = []
    for k in range(120):
        words = ["intro"] * int(draw.integers(0, 4)) + list(known[k % len(known)][1]) + ["outro"] * int(draw.integers(0, 4))
        for _ in range(int(draw.integers(0, 1 + len(words) // 6))):
            at, what = int(draw.integers(0, len(words))), int(draw.integers(0, 3))
            words[at : at + (what > 0)] = ["other"] * (what < 2)
        rows.append((k, " ".join(words)))
    pairs = lambda ws: {*zip(ws, ws[1:])}
    expected = {}
    for k, text in rows:
        ws, hits = text.split(), []
        for rank, (name, t) in enumerate(known):
            chosen = {tuple(p.split(" ")) for p in anchors([" ".join(p) for p in pairs(t)], LEAST_DICE)}
            for at in {max(0, i - j) for i, p in enumerate(zip(ws, ws[1:])) for j, q in enumerate(zip(t, t[1:])) if p == q and q in chosen}:
                v, m = pairs(ws[at : at + len(t)]), pairs(t)
                if 2 * len(v & m) / (len(v) + len(m)) >= LEAST_DICE:
                    hits.append((2 * len(v & m) / (len(v) + len(m)), len(t), -rank, name, at))
        stay = [h for h in hits if not any(g[3] != h[3] and g[4] < h[4] + h[1] and h[4] < g[4] + g[1] and g[:3] > h[:3] for g in hits)]
        expected[k] = (";".join(sorted({h[3] for h in stay})), max(stay)[3] if stay else None, round(max(stay)[0], 6) if stay else None)
    got = {r.doc_id: (r.licenses, r.best_license, r.best_dice) for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == expected and len({e[0] for e in expected.values()}) > 5


def test_a_window_that_reaches_the_coefficient_holds_an_anchor():
    """Sets of a template's bigrams with as many missing as may be, and nothing else: each holds an anchor."""
    for size in range(1, 60):
        pairs = [f"w{k} v" for k in range(size)]
        chosen = anchors(pairs, LEAST_DICE)
        fewest = min(c for c in range(1, size + 1) if 2 * c >= LEAST_DICE * (c + size))
        assert len(chosen) + fewest == size + 1



def test_urls_follow_rules_and_links(spark, checkpoint_store):
    link = '<a href="https://{}/x">t</a>'.format
    pages = [
        (1, "https://a.com/", link("good.org") * 2), (2, "http://www.EXAMPLE.com/en/x?y", ""), (3, "http://example.com/en/", ""),
        (4, "http://bad.net/es/1", ""), (5, "http://fan.org/", link("bad.net")), (6, "http://good.org/#t", None),
        (7, None, None), (8, "no scheme", ""), (9, "http://shop.com", ""), (10, "http://bad.net/de/", ""),
    ]
    got = {r.page_id: r for r in judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), checkpoint_store).collect()}
    assert [got[k].rule for k in range(1, 11)] == ["com/", "www.example.com/en/", "example.com/en/", "net/es/", None, None, None, None, None, None]
    assert got[6].trust == pytest.approx(0.85) and got[5].distrust == pytest.approx(0.85 * 0.5)
    assert got[10].verdict == "block" and got[5].verdict == "allow" and got[3].verdict == "block"
    assert (got[7].host, got[7].path, got[7].verdict) == ("", "", "allow") and got[9].host == "shop.com"


def test_trust_on_cycles_converges_whatever_the_number_of_seeds(spark, checkpoint_store):
    """Rings of three and a ring of many with a shortcut, solved exactly by linear algebra."""
    names = [f"h{k}" for k in range(40)]
    links = [(a, b) for k in range(0, 30, 3) for a, b in ((k, k + 1), (k + 1, k + 2), (k + 2, k))]
    links += [(k, 30 + (k - 29) % 10) for k in range(30, 40)] + [(30, 35), (0, 30)]
    seeds = [float(k % 4 == 0) for k in range(40)]
    step = np.zeros((40, 40))
    for a, b in links:
        step[b, a] = 0.85 / sum(a == x for x, _ in links)
    exact = np.linalg.solve(np.eye(40) - step, seeds)
    for scale in (1.0, 1e6):
        frame = spark.createDataFrame([(n, s * scale) for n, s in zip(names, seeds)], "host string, seed double")
        edges = spark.createDataFrame([(names[a], names[b]) for a, b in links], "src string, dst string")
        got = {r.host: r.score for r in propagate(frame, edges, checkpoint_store, f"ring-{scale:.0f}").collect()}
        assert max(abs(got[n] / scale - e) for n, e in zip(names, exact)) <= 1e-5 * sum(seeds)


def test_a_language_without_letters_is_not_learned(spark):
    rows = [(k, "the cat and the dog" if k % 2 else "der hund und die katze", "en" if k % 2 else "de") for k in range(60)]
    rows += [(100 + k, "123 456", "zz") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(learn_dictionaries(docs)) == {"en", "de"}
    got = {r.doc_id: r.lang_pred for r in identify_languages(docs).collect()}
    assert all(got[k] == "und" for k in range(100, 160)) and got[1] == "en" and got[2] == "de"
    assert learn_dictionaries(docs.filter("lang = 'zz'")) == {} and learn_dictionaries(docs.withColumn("lang", F.lit(None).cast("string"))) == {}


def test_embedding_links(spark, checkpoint_store):
    draw = np.random.default_rng(1)
    base = draw.standard_normal((60, 16))
    near = [base[0] + 0.2 * draw.standard_normal(16) for _ in range(60)] + [base[1] * s for s in (1, 2, 3)]
    x = np.concatenate([base, near])
    rows = [(k, [float(v) for v in r]) for k, r in enumerate(x)]
    odd = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [1.0, None]), (905, [1.0, 2.0])]
    got = {r.vec_id: r for r in link_embeddings(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>"), checkpoint_store).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    assert [got[k].n_links for k in range(len(x))] == (linked.sum(axis=1) - 1).tolist()
    top = list(range(len(x)))
    for _ in top:
        top = [min(top[j] for j in np.flatnonzero(linked[k])) for k in range(len(x))]
    assert [got[k].component_id for k in range(len(x))] == top
    assert all(got[k].n_links == 0 and got[k].kept for k, _ in odd)
