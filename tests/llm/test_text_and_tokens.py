"""Words, n-grams, token ids and packing against plain Python."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tradeflow.llm import text_arrays as ta
from tradeflow.llm.packing import CAPACITY, Slots, _best_fit, pack_documents, plan
from tradeflow.llm.storage import Store
from tradeflow.llm.token_counts import token_report
from tradeflow.llm.tokens import Encoder, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    None,
    "",
    " ",
    "one",
    "a<|endoftext|> b <|endoftext|>",
    "x  y  z　 q\n\n r",
    " lead and trail  \n",
    "\x1c a\x1c b\x85 c",
    "it's  don't\t\n x 12 345",
    "日本 語   x é è",
    "\u0085 z a  b",
    "a \n\n b\n",
    "same same same same same same",
    "word " * 3000,
    "nospace" * 500,
]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(tokenizer_path())


def column(texts):
    return pa.array(texts, pa.large_string())


def random_texts(seed, n=60):
    draw = random.Random(seed)
    pieces = ["a", "be", "the ", " ", "\n", "\t", "  ", "é", " ", " ", "<|endoftext|>", "'s", "12", "!", "日", "\x1d"]
    return ["".join(draw.choice(pieces) for _ in range(draw.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_words_are_the_runs_the_pattern_finds(seed):
    texts = TEXTS + random_texts(seed)
    words = ta.Words(column(texts))
    expected = [WORD.findall(t or "") for t in texts]
    assert words.count.tolist() == [len(w) for w in expected]
    found = [words.data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends)]
    assert found == [w for ws in expected for w in ws]
    names = {}
    for word, name in zip(found, words.hash.tolist()):
        assert names.setdefault(word, name) == name
    assert len(set(names.values())) == len(names)


@pytest.mark.parametrize("n", [2, 5])
def test_grams_name_the_same_runs_of_words_alike(n):
    texts = ["a b c d e f a b c d e", "a b c d e", "a b", None, "b a"]
    row, value = ta.Words(column(texts)).grams(n, whole=True)
    expected = []
    for k, text in enumerate(texts):
        words = WORD.findall(text or "")
        if words:
            expected += [(k, tuple(words[i : i + n])) for i in range(max(1, len(words) - n + 1))]
    assert row.tolist() == [k for k, _ in expected]
    names = {}
    for (_, gram), name in zip(expected, value.tolist()):
        assert names.setdefault(gram, name) == name
    assert len(set(names.values())) == len(names)


def test_slices_of_a_column_are_read_from_their_start():
    words = ta.Words(column(["a b", "c", None, "d e f"]).slice(1, 3))
    assert words.count.tolist() == [1, 0, 3]


@pytest.mark.parametrize("seed", range(6))
def test_ids_are_those_of_the_library(encoder, seed):
    encoder.forget()
    texts = random_texts(seed) + TEXTS
    random.Random(seed).shuffle(texts)
    expected = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert encoder.counts(column(texts)).tolist() == [len(e) for e in expected]
    got = [ids[a:b].tolist() for ids, cut in encoder.row_ids(column(texts)) for a, b in zip(cut[:-1], cut[1:])]
    assert got == expected


def test_token_report(spark, encoder):
    rows = [(k, t, "x") for k, t in enumerate(TEXTS)] + [(0, None, "x")]
    report = token_report(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")).collect()
    assert len(report) == len(rows)
    for r in report:
        text = TEXTS[r.doc_id] or ""
        tokens = len(encoder.tokenizer.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), tokens, tokens > 512)
    assert token_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_plan_uses_every_piece_once_and_fits(seed):
    draw = np.random.default_rng(seed)
    capacity = 64
    counts = draw.integers(0, 40, capacity + 1) * (draw.random(capacity + 1) < 0.6)
    counts[0] = 0
    patterns = plan(counts.tolist(), capacity)
    used = np.zeros(capacity + 1, int)
    for lengths, times in patterns:
        assert sum(lengths) <= capacity and times > 0
        for size in lengths:
            used[size] += times
    assert used.tolist() == counts.tolist()
    # Few lengths leave gaps that no plan can fill, so the yardstick is best-fit decreasing.
    plain = sum(times for _, times in _best_fit(counts.tolist(), capacity))
    assert sum(times for _, times in patterns) <= plain + max(3, plain // 40)
    slots = Slots(patterns)
    places = set()
    for size in np.flatnonzero(counts):
        sequence, offset = slots.find(np.full(counts[size], size), np.arange(counts[size]))
        places |= {(s, o, int(size)) for s, o in zip(sequence.tolist(), offset.tolist())}
    assert len(places) == counts.sum()


def test_many_lengths_come_close_to_the_bound():
    lengths = np.random.default_rng(1).lognormal(3.6, 1.2, 20_000).astype(int) % 128 + 1
    counts = np.bincount(lengths, minlength=129)
    least = max(-(-int(lengths.sum()) // 128), int(counts[65:].sum()))
    assert sum(times for _, times in plan(counts.tolist(), 128)) <= 1.005 * least


def test_exact_complements_come_first():
    counts = [0] * 11
    for size in (6, 4, 7, 2, 1, 3, 3, 3, 10):
        counts[size] += 1
    assert all(sum(lengths) == 10 for lengths, _ in plan(counts, 10)[:3])


def test_packing_is_a_round_trip(spark, encoder, checkpoint_store):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(3, "one"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    placed = pack_documents(docs, checkpoint_store).collect()
    expected = []
    for doc_id, text in rows:
        ids = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        first = (len(ids) - 1) % CAPACITY + 1
        cuts = [0, *range(first, len(ids) + 1, CAPACITY)]
        for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            expected.append((doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r)[:5] for r in placed), key=key) == sorted(expected, key=key)
    sequences = {}
    for r in placed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= CAPACITY
    assert len(sequences) <= -(-sum(r.length for r in placed) // CAPACITY) + 1


def test_packing_nothing(spark, checkpoint_store):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), checkpoint_store).count() == 0
    assert isinstance(checkpoint_store, Store)
