"""Every stage of the corpus pipeline against a plain version of it, and the whole run."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations
from math import log

import corpus_pipeline
import numpy as np
import pytest
from tradeflow.llm import quality
from tradeflow.llm.mixing import BUDGET_PERCENT, EPOCHS, SEED, WEIGHTS
from tradeflow.llm.packing import CAPACITY, END
from tradeflow.llm.tokens import tokenizer_path

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows that each stage got and gave, written and read in between as a run does."""
    base, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        got = docs.collect()
        stage(spark, docs, SF).write.parquet(f"{base}/{number}")
        docs = spark.read.parquet(f"{base}/{number}")
        out[name] = got, docs.collect()
    return out


def test_stages_are_the_ones_agreed_on(stages):
    assert list(stages) == ["quality_rules", "language_id", "near_dedup", "mix_sources", "pack"]
    for name, (got, given) in stages.items():
        if name != "pack":
            assert list(given[0].asDict()) == list(got[0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars"]


def base_failed(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[k : k + quality.WINDOW]) for k in range(len(words) - quality.WINDOW + 1)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {k + i for k, w in enumerate(windows) if w in often for i in range(quality.WINDOW)}
    return len(words) < quality.LEAST_WORDS or 100 * len(covered) > quality.MOST_REPEATED_PERCENT * len(words)


def test_quality_rules(spark, stages):
    got, given = stages["quality_rules"]
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    grams = {}
    for r in got:
        words = WORD.findall(r.text or "")
        grams[r.doc_id] = Counter(words) + Counter(zip(words, words[1:]))
    every, trusted = Counter(), Counter()
    for doc_id, own in grams.items():
        every.update(own)
        trusted.update(own if doc_id in good else {})
    kept, ratios = {r.doc_id for r in given}, {}
    for r in got:
        own, inside = grams[r.doc_id], r.doc_id in good
        all_found, rest, score = trusted.total() - own.total() * inside, every.total() - own.total(), 0.0
        for gram, n in own.items():
            expected = (every[gram] - n) * all_found / rest
            score += n * log((trusted[gram] - n * inside + quality.PRIOR) / (expected + quality.PRIOR))
        ratios[r.doc_id] = score / max(own.total(), 1)
    for r in got:
        # Grams may share a bucket, so what lies at the threshold may fall on either side.
        if base_failed(r.text):
            assert r.doc_id not in kept
        elif abs(ratios[r.doc_id] - quality.LEAST_RATIO) > 0.03:
            assert (r.doc_id in kept) == (ratios[r.doc_id] > quality.LEAST_RATIO)
    clean = [r.doc_id for r in got if r.doc_id in good and not base_failed(r.text)]
    assert len(clean) > 20 and sum(d in kept for d in clean) >= 0.97 * len(clean)


def test_language_id(stages):
    got, given = stages["language_id"]
    assert {r.doc_id for r in given} <= {r.doc_id for r in got} and len(given) >= 0.95 * len(got)
    assert all(r in got for r in given)


def test_near_dedup(stages):
    got, given = stages["near_dedup"]
    sets = {}
    for r in got:
        words = WORD.findall(r.text)
        sets[r.doc_id] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    top = {d: d for d in sets}

    def root(d):
        while top[d] != d:
            d = top[d]
        return d

    for a, b in combinations(sorted(sets), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            low, high = sorted((root(a), root(b)))
            top[high] = low
    assert sorted(r.doc_id for r in given) == sorted(d for d in top if root(d) == d)
    assert len(given) < len(got)


def test_mix_sources(stages):
    got, given = stages["mix_sources"]
    size = {r.doc_id: len(WORD.findall(r.text)) for r in got}
    queues = defaultdict(list)
    for r in got:
        queues[r.source].append((int(hashlib.md5(f"{SEED}{r.doc_id}".encode()).hexdigest()[:15], 16), r.doc_id))
    lined = []
    for rank, source in enumerate(sorted(queues)):
        words = sum(size[d] for _, d in queues[source])
        for epoch in range(EPOCHS):
            ahead = 0
            for turn, d in sorted(queues[source]):
                ahead += size[d]
                lined.append(((epoch * words + ahead) / WEIGHTS[rank % len(WEIGHTS)], rank, turn, d, epoch))
    budget, taken, used = sum(size.values()) * BUDGET_PERCENT // 100, Counter(), 0
    for *_, d, _ in sorted(lined):
        used += size[d]
        if used > budget:
            break
        taken[d] += 1
    assert Counter(r.doc_id for r in given) == taken and max(taken.values()) == EPOCHS


def test_pack(stages):
    from tokenizers import Tokenizer

    got, given = stages["pack"]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for r in got:
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [END]
        size, at = (len(ids) - 1) % CAPACITY + 1, 0
        for piece in range(-(-len(ids) // CAPACITY)):
            want[r.doc_id, piece, at, size, zlib.crc32(np.array(ids[at : at + size], "<u4").tobytes())] += 1
            at, size = at + size, CAPACITY
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in given) == want
    sequences = defaultdict(list)
    for r in given:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        ends = np.cumsum([length for _, length in sorted(own)])
        assert [offset for offset, _ in sorted(own)] == [0, *ends[:-1].tolist()] and ends[-1] <= CAPACITY
    assert len(sequences) <= 1.02 * -(-sum(r.length for r in given) // CAPACITY) + 1


def test_a_run_is_its_stages(spark, stages):
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    got = Counter(tuple(r[c] for c in columns) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == Counter(tuple(r[c] for c in columns) for r in stages["pack"][1])


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)] * 2 + [(1, "", "", "", 0)]])
def test_stages_take_empty_tables_and_nulls(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        given = stage(spark, docs, SF)
        assert given.count() == (0 if name in ("quality_rules", "language_id") or not rows else given.count())
