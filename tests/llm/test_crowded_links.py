"""A group of embeddings with far more links than a list holds, and too wide to be contracted."""

import numpy as np
import pytest
from tradeflow.llm import embedding_links as el


def _brute(x, least=el.LEAST_COSINE):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= least
    top = np.arange(len(x))
    while True:
        low = np.array([top[linked[k]].min() for k in range(len(x))])
        if np.array_equal(low, top):
            return linked.sum(axis=1) - 1, top
        top = low


def test_no_link_of_a_wide_group_is_lost(spark, checkpoint_store):
    """3,000 vectors at cosines of 0.88 to 0.97 of each other, 300 others, and a second group far away."""
    draw = np.random.default_rng(8)
    dims = 24
    spread = lambda n, at: at + draw.standard_normal((n, dims)) * np.linalg.norm(at) * draw.uniform(0.04, 0.07, (n, 1))
    x = np.concatenate([spread(3000, draw.standard_normal(dims)), draw.standard_normal((300, dims)), spread(150, draw.standard_normal(dims))])
    frame = spark.createDataFrame([(k, [float(v) for v in row]) for k, row in enumerate(x)], "vec_id long, embedding array<double>").repartition(6)
    got = {r.vec_id: r for r in el.link_embeddings(frame, checkpoint_store).collect()}
    n_links, component = _brute(x)
    assert n_links.max() > 10 * el.LONGEST
    assert [got[k].n_links for k in range(len(x))] == n_links.tolist()
    assert [got[k].component_id for k in range(len(x))] == component.tolist()


@pytest.mark.parametrize("seed", [1, 2])
def test_regions_leave_nothing_out(spark, checkpoint_store, seed):
    """The exact count alone, over vectors of two lengths of which any may be in the crowd."""
    draw = np.random.default_rng(seed)
    x = [draw.standard_normal(3) if k % 9 else draw.standard_normal(4) for k in range(700)]
    x = [v / np.linalg.norm(v) for v in x]
    vectors = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "uid long, v array<double>").repartition(4)
    inside = set(draw.choice(700, 200, replace=False).tolist())
    crowd = spark.createDataFrame([(k,) for k in inside], "uid long")
    got, ends = {}, set()
    for r in el.crowd_links(crowd, vectors, checkpoint_store, 0.9, 10 + seed).collect():
        got[r.uid] = got.get(r.uid, 0) + r.n
        ends.add((r.uid, r.to))
    linked = [[j for j in range(700) if j != k and len(x[j]) == len(x[k]) and x[j] @ x[k] >= 0.9] for k in range(700)]
    for k in range(700):
        assert got.get(k, 0) == (len(linked[k]) if k in inside else sum(j in inside for j in linked[k]))
    top = list(range(700))

    def root(k):
        while top[k] != k:
            k = top[k]
        return k

    for a, b in ends:
        top[max(root(a), root(b))] = min(root(a), root(b))
    found = [root(k) for k in range(700)]
    top = list(range(700))
    for k in inside:
        for j in linked[k]:
            top[max(root(k), root(j))] = min(root(k), root(j))
    assert found == [root(k) for k in range(700)]


def test_a_recall_that_stays_low_is_an_error(spark, checkpoint_store, monkeypatch):
    monkeypatch.setattr(el, "_audit", lambda *_: 0.5)
    frame = spark.createDataFrame([(k, [1.0, k / 50]) for k in range(40)], "vec_id long, embedding array<double>")
    with pytest.raises(RuntimeError, match="0.5000 of the audited links"):
        el.link_embeddings(frame, checkpoint_store)
