"""The verdict by the gram model: left-out good documents, few and many labels, many different grams."""

from collections import Counter
from math import log

import numpy as np
import pyarrow as pa
import pytest
from tradeflow.llm import quality
from tradeflow.llm import text_arrays as ta
from tradeflow.llm.quality import PRIOR, gram_model, judge_quality

LABELS = "doc_id long, quality int"


def grams(text):
    words = text.split()
    return Counter(words) + Counter(zip(words, words[1:]))


@pytest.mark.parametrize("sf,most_rejected", [("sf0.001", 0.05), ("sf0.01", 0.05)])
def test_left_out_good_documents_stay(spark, sf, most_rejected):
    base = f"/root/testdata/{sf}"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    held = {r[0] for r in labels.filter("quality = 1 AND doc_id % 5 = 0").collect()}
    got = judge_quality(docs, labels.filter("NOT (quality = 1 AND doc_id % 5 = 0)")).collect()
    clean = [r for r in got if r.doc_id in held and not r.base_failed]
    assert len(clean) > 5 and sum(not r.kept for r in clean) <= most_rejected * len(clean)


def test_ratio_equals_brute_force(spark):
    draw = np.random.default_rng(3)
    texts = [" ".join(f"w{n}" for n in draw.zipf(1.4, 60) % 500) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    good = set(range(0, 40, 3))
    got = {r.doc_id: r.ratio for r in judge_quality(docs, spark.createDataFrame([(k, int(k in good)) for k in range(40)], LABELS)).collect()}
    model = gram_model(docs, spark.createDataFrame([(k, 1) for k in good], LABELS), bits=22).unpacked()
    words = ta.Words(ta.as_large(pa.array(texts)))
    exact = quality.ratios(words, np.array([k in good for k in range(40)]), model)
    every, trusted = Counter(), Counter()
    for k, text in enumerate(texts):
        every += grams(text)
        trusted += grams(text) if k in good else Counter()
    for k, text in enumerate(texts):
        own, score = grams(text), 0.0
        all_trusted = trusted.total() - (own.total() if k in good else 0)
        for gram, n in own.items():
            found = trusted[gram] - (n if k in good else 0)
            expected = (every[gram] - n) * all_trusted / (every.total() - own.total())
            score += n * log((found + PRIOR) / (expected + PRIOR))
        assert exact[k] == pytest.approx(score / own.total(), abs=2e-3)
        # At 2**14 buckets some grams share one.
        assert got[k] == pytest.approx(score / own.total(), abs=0.05)


def test_buckets_follow_the_text_and_all_labels_count(spark):
    """Junk among so many different words that 2**14 buckets hold a hundred each is still told from prose."""
    draw = np.random.default_rng(5)
    prose = [" ".join(f"p{n}" for n in draw.integers(0, 60_000, 400)) for _ in range(1500)]
    junk = [" ".join(f"j{n}" for n in draw.integers(0, 300, 400)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(prose + junk)), "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, 1) for k in range(700)], LABELS)
    model = gram_model(docs, labels)
    assert model.bits > 14 and model.trusted_grams == 700 * 799 and model.corpus_grams == 1560 * 799
    got = {r.doc_id: r.kept for r in judge_quality(docs, labels).collect()}
    assert all(got[k] for k in range(1500)) and not any(got[k] for k in range(1500, 1560))
