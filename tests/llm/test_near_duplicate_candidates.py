"""Candidates of near duplicates: repeated passages, and pairs in large buckets."""

import numpy as np
import pyarrow as pa
from tradeflow.llm import near_duplicates as nd


def test_a_repeated_passage_does_not_hide_a_copy(spark, checkpoint_store):
    draw = np.random.default_rng(7)
    rows = []
    for k in range(40):
        words = [f"w{n}" for n in draw.integers(0, 1_000_000, 300)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words + words[:90] * 300))]
    got = nd.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string"), checkpoint_store).collect()
    assert {r.doc_id: r.class_id for r in got} == {k: k - k % 2 for k in range(80)}


def _block(hashes, shingles, band, bands):
    n = len(shingles)
    return pa.table(
        {
            "doc_id": list(range(n)),
            "component": list(range(n)),
            "shingles": shingles,
            "probe": [True] + [False] * (n - 1),
            "band": [band] * n,
            "bands": pa.array(bands, pa.list_(pa.int64())),
            "signature": pa.array([bytes(nd.BANDS * nd.ROWS_PER_BAND)] * n, pa.binary()),
            "lowest": pa.array(hashes, pa.list_(pa.int64())),
        }
    )


def test_a_pair_is_compared_in_the_first_band_with_equal_keys():
    """All signature bytes agree, by chance, but the keys are equal from band 3 on alone."""
    same = list(range(10))
    bands = [[100 * (k < 3) * row + k for k in range(nd.BANDS)] for row in range(2)]
    bands[1] = [b if k >= 3 else b + 1 for k, b in enumerate(bands[1])]
    compare = nd._block_comparer(0.8)
    assert [compare(_block([same, same], [10, 10], band, bands)).num_rows for band in range(5)] == [0, 0, 0, 1, 0]


def test_full_lists_give_an_estimate():
    """256 shingles each, 228 common: similarity 228/284 = 0.803, but less among the 256 smallest of the union."""
    a = list(range(28)) + list(range(100, 328))
    b = list(range(28, 56)) + list(range(100, 328))
    assert len(set(a) & set(b)) >= 0.8 * len(set(a) | set(b))
    bands = [list(range(nd.BANDS))] * 2
    assert nd._block_comparer(0.8)(_block([a, b], [256, 256], 0, bands)).num_rows == 1


def test_equal_ids_with_different_texts_keep_every_text(spark, checkpoint_store):
    a, b, c = (" ".join(f"{x}{n}" for n in range(40)) for x in "abc")
    near = c + " more"
    rows = [(0, a), (1, a), (1, b), (2, c), (2, near), (2, c), (3, None), (3, ""), (3, " \n"), (None, a), (4, b), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.text) for r in nd.distinct_documents(docs, checkpoint_store).collect() if r.text and r.text.strip() and r.doc_id is not None)
    assert got[:2] == [(0, a), (1, b)] and len(got) == 3 and got[2][0] == 2 and got[2][1] in (c, near)
    wordless = [(r.doc_id, r.text) for r in nd.distinct_documents(docs, checkpoint_store).collect() if r.doc_id is None or not (r.text or "").strip()]
    assert sorted(wordless, key=repr) == sorted([(3, None), (3, ""), (3, " \n"), (None, a), (4, None)], key=repr)
    classes = nd.near_duplicate_classes(docs, checkpoint_store).collect()
    assert len(classes) == len(rows)
    assert sorted((r.doc_id, r.class_id) for r in classes if r.doc_id in (0, 1, 4) and r.words) == [(0, 0), (1, 0), (1, 1), (4, 1)]


def test_texts_that_share_no_bucket_are_dropped_before_the_shuffle(spark, monkeypatch):
    from tradeflow.llm import near_duplicates, storage

    plans, keep = {}, storage.Store.keep
    monkeypatch.setattr(storage.Store, "keep", lambda self, df, name: plans.setdefault(name, df._jdf.queryExecution().toString()) and keep(self, df, name))
    near = " ".join(f"w{k}" for k in range(60))
    made = [(k, " ".join(f"t{k}-{n}" for n in range(40))) for k in range(50)] + [(50, near), (51, near + " more")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = storage.Store(spark)
        docs = store.keep(spark.createDataFrame(made, "doc_id long, text string"), "docs")
        classes = near_duplicates.near_duplicate_classes(docs, store).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [r.doc_id for r in classes if not r.kept] == [51]
    assert "might_contain" in plans["near-shingles"]
    assert spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold") != "1t"
