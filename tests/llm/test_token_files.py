"""Token files: exact round trips, random access, what a failed attempt leaves."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tradeflow.llm import patched_blocks as pb
from tradeflow.llm import text_arrays as ta
from tradeflow.llm import token_files as tf
from tradeflow.llm.tokens import tokenizer_path
from tradeflow.llm.word_tokens import WORD_TOKENIZER, WordEncoder

DOCS = "doc_id long, text string, ids string, path string"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(WORD_TOKENIZER))


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [tf.END_ID]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 3000), st.sampled_from([1, 2, 3, 300, 49408, 1 << 20, 1 << 32]), st.integers(0, 9), st.integers(0, 2**32 - 1))
def test_blocks_round_trip(n, limit, outliers, seed):
    draw = np.random.default_rng(seed)
    numbers = draw.integers(0, limit, n, dtype=np.uint64).astype(np.uint32)
    if n:
        numbers[draw.integers(0, n, outliers)] = draw.integers(0, 1 << 32, outliers, dtype=np.uint64)
    blocks = pb.encode(numbers)
    assert len(blocks) == -(-n // pb.BLOCK) and np.array_equal(pb.decode(blocks), numbers)


def test_a_block_pays_for_outliers_one_by_one():
    numbers = np.arange(pb.BLOCK, dtype=np.uint32) % 16 + 1_000_000
    plain = len(pb.encode(numbers)[0])
    assert plain == pb.HEAD.size + pb.BLOCK * 4 // 8
    numbers[[5, 700]] = 4_000_000_000
    assert len(pb.encode(numbers)[0]) == plain + 2 * 6
    assert len(pb.encode(np.full(pb.BLOCK, 77, np.uint32))[0]) == pb.HEAD.size


def test_words_give_the_library_s_ids(tokenizer):
    draw = random.Random(5)
    pieces = [*"abcXYZ.,;:!?'\"-éÉÜß×÷…»«\t\n", "'s", "'LL", "\r\n", "12", "İ", "ſ", "Σς", "K", "Å", "é", "Å", " ", "中文", "<|endoftext|>", "<|ENDOFTEXT|>", " ", " "]
    plain = [p for p in pieces if "|" not in p]
    texts = ["".join(draw.choice(own) for _ in range(draw.randint(0, 40))) for own in (pieces, plain) for _ in range(3000)]
    texts += ["", None, "x" * 50_000, "A. b"]
    encoder, got = WordEncoder(tokenizer_path(WORD_TOKENIZER)), []
    for ids, offsets in encoder.row_ids(ta.as_large(pa.array(texts, pa.string()))):
        got += [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
    assert got == [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def expected(tokenizer, rows):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = ids_of(tokenizer, text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_agree_with_the_library(spark, checkpoint_store, tokenizer):
    draw = random.Random(1)
    rows = [(k * 3, " ".join(draw.choice(["One", "two,", "három", "4", "\n"]) for _ in range(draw.randint(0, 90)))) for k in range(400)]
    rows += [(None, "no id"), (2000, None), (2001, ""), (2002, "a b " * 140_000), (-7, "before"), (2003, "after")]
    docs = spark.createDataFrame([(*r, "i", "p") for r in rows], DOCS).repartition(6)
    manifest = tf.write_ids(docs, checkpoint_store, name="ids-one")
    assert manifest.count() > 1
    got = sorted((tuple(r) for r in tf.read_report(manifest).collect()), key=lambda r: r[1])
    assert got == expected(tokenizer, rows)
    assert any(n > tf.STEP for _, _, n, _ in got)
    texts = {r.doc_id: r.ids for r in tf.read_ids(manifest).filter("doc_id < 90").collect()}
    assert texts == {k: ids_of(tokenizer, text) for k, text in rows if k is not None and k < 90}


def test_rows_of_one_id_and_no_rows(spark, checkpoint_store, tokenizer):
    rows = [(1, "same text")] * 30 + [(1, "other"), (2, "last")]
    docs = spark.createDataFrame([(*r, "i", "p") for r in rows], DOCS)
    got = sorted((tuple(r) for r in tf.token_files(docs, checkpoint_store).collect()), key=lambda r: r[1])
    assert sorted((r[0], r[2], r[3]) for r in got) == sorted((r[0], r[2], r[3]) for r in expected(tokenizer, rows))
    assert [r[1] for r in got] == np.concatenate([[0], np.cumsum([r[2] for r in got])[:-1]]).tolist() and got[-1][0] == 2
    assert tf.token_files(docs.limit(0), checkpoint_store).count() == 0


def test_any_run_of_ids_is_read_through_the_index(tmp_path):
    draw = np.random.default_rng(2)
    ids = draw.integers(0, 50_000, 3 * pb.BLOCK + 100).astype(np.uint32)
    path = f"{tmp_path}/x.ids"
    writer = tf.IdFileWriter(path)
    for a in range(0, len(ids), 517):
        part = ids[a : a + 517]
        writer.add([a, None][: 1 + (len(part) > 1)], np.array([1, len(part) - 1][: 1 + (len(part) > 1)]), part)
    writer.close()
    file = tf.IdFile(path)
    assert file.ids == len(ids) == file.lengths.sum() and file.doc_ids.null_count == (len(file.lengths)) // 2
    for a, b in [(0, 0), (0, 1), (1000, 1100), (1024, 2048), (3000, len(ids)), (0, len(ids)), *draw.integers(0, len(ids), (20, 2)).tolist()]:
        assert np.array_equal(file.between(a, b), ids[a:b] if b > a else ids[:0])
    with open(path, "r+b") as raw:
        raw.seek(-1, 2)
        raw.write(b"x")
    with pytest.raises(ValueError, match="no file of token ids"):
        tf.IdFile(path)


def test_a_file_that_no_manifest_names_is_not_read(spark, checkpoint_store):
    docs = spark.createDataFrame([(1, "a", "i", "p"), (2, "b", "i", "p")], DOCS)
    manifest = tf.write_ids(docs, checkpoint_store, name="ids-two")
    path = manifest.first()["path"]
    lost = tf.IdFileWriter(path.replace(".ids", "-lost.ids"))
    lost.add([9], np.array([2]), np.array([5, 1], np.uint32))
    lost.close()
    assert sorted(r.doc_id for r in tf.read_report(manifest).collect()) == [1, 2]
