import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from conftest import brute_force
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.operators import blocks
from shelfmark.operators.blocks import TopK, drop_far_copies, vectors_of


def search(qids, q, iids, x, k, metric, cuts=()):
    best = TopK(np.asarray(qids), np.asarray(q, dtype=np.float32), k, metric, 6)
    x = np.asarray(x, dtype=np.float32)
    for part in np.split(np.arange(len(iids)), list(cuts)):
        best.add(np.asarray(iids)[part], x[part])
    batch = best.result()
    return set(zip(*(c.to_pylist() for c in batch.columns))) if batch.num_rows else set()


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_equals_brute_force_with_ties_and_copies(data):
    dim = data.draw(st.integers(1, 4))
    value = st.integers(-2, 2)
    vector = st.lists(value, min_size=dim, max_size=dim)
    q = data.draw(st.lists(vector, min_size=1, max_size=4))
    x = data.draw(st.lists(vector, min_size=1, max_size=25))
    k = data.draw(st.integers(1, 6))
    metric = data.draw(st.sampled_from(["l2", "cosine"]))
    ids = data.draw(st.permutations(range(len(x))))
    cut = data.draw(st.integers(0, len(x)))
    got = search(range(len(q)), q, ids, x, k, metric, [cut])
    assert got == brute_force(range(len(q)), q, ids, x, k, metric)


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("scale", [1e-3, 1.0, 1e3])
def test_equals_brute_force_over_many_tiles(monkeypatch, metric, scale):
    monkeypatch.setattr(blocks, "QUERY_TILE", 7)
    monkeypatch.setattr(blocks, "ITEM_TILE", 31)
    monkeypatch.setattr(blocks, "RESCORE_VALUES", 64)
    rng = np.random.default_rng(3)
    q, x = rng.normal(size=(20, 16)) * scale, rng.normal(size=(300, 16)) * scale
    x[50:150] = x[7]  # a third of the items are copies
    ids = rng.permutation(300)
    got = search(range(20), q, ids, x, 5, metric, [40, 41, 200])
    assert got == brute_force(range(20), q, ids, x, 5, metric)


def test_one_far_item_does_not_blur_the_screen():
    rng = np.random.default_rng(4)
    q, x = rng.normal(size=(5, 8)), rng.normal(size=(100, 8))
    x[0] *= 1e6
    assert search(range(5), q, range(100), x, 3, "l2") == brute_force(range(5), q, range(100), x, 3)


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_queries_that_tie_on_most_items(monkeypatch, metric):
    monkeypatch.setattr(blocks, "ITEM_TILE", 200)
    rng = np.random.default_rng(11)
    x = np.eye(64)[rng.integers(0, 64, 900)] * rng.choice([1.0, 2.0], size=(900, 1))
    x[::7] = rng.normal(size=(len(x[::7]), 64))
    q = np.concatenate([np.zeros((2, 64)), np.ones((1, 64)), np.eye(64)[:3], rng.normal(size=(4, 64))])
    ids = rng.permutation(900)
    for k in (1, 5, 30):
        got = search(range(10), q, ids, x, k, metric, [100, 650])
        assert got == brute_force(range(10), q, ids, x, k, metric)


def test_every_query_may_take_the_crowded_path(monkeypatch):
    monkeypatch.setattr(blocks, "CROWDED", 0)
    rng = np.random.default_rng(12)
    q, x = rng.integers(-2, 3, size=(15, 3)), rng.integers(-2, 3, size=(120, 3))
    for metric in ("l2", "cosine"):
        for k in (1, 4, 200):
            got = search(range(15), q, range(120), x, k, metric, [50])
            assert got == brute_force(range(15), q, range(120), x, k, metric)


def test_nan_items_are_never_found():
    x = [[np.nan, 0.0], [1.0, 0.0], [2.0, 0.0]]
    got = search([1], [[0.0, 0.0]], [1, 2, 3], x, 3, "l2")
    assert {r[1] for r in got} == {2, 3}


def test_copies_keep_the_smallest_ids():
    ids, kept = drop_far_copies(np.array([9, 3, 5, 1]), np.ones((4, 2), dtype=np.float32), 2)
    assert sorted(ids) == [1, 3] and kept.shape == (2, 2)


def test_vector_checks():
    assert vectors_of(pa.array([[1.0, 2.0], [3.0, 4.0]], pa.list_(pa.float32()))).shape == (2, 2)
    sliced = pa.array([[9.0, 9.0], [1.0, 2.0]], pa.list_(pa.float32())).slice(1)
    assert vectors_of(sliced).tolist() == [[1.0, 2.0]]
    for bad in ([[1.0], [1.0, 2.0, 3.0]], [[1.0, None]], [[1.0], None]):
        with pytest.raises(ValueError):
            vectors_of(pa.array(bad, pa.list_(pa.float32())))
    with pytest.raises(ValueError):
        search([1], [[0.0, 0.0]], [1], [[0.0]], 1, "l2")
    with pytest.raises(ValueError):
        search([1], [[0.0]], [1], [[0.0]], 1, "manhattan")


def test_copies_are_told_without_wide_copies_of_all():
    x = np.random.default_rng(8).normal(size=(60_000, 64)).astype(np.float32)
    x[30_000:] = x[:30_000]
    tracemalloc.start()
    labels = blocks.same_vectors(x)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(labels, np.tile(np.arange(30_000), 2))
    assert most < 3 * x.nbytes


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_products_are_made_strip_by_strip(monkeypatch, metric):
    monkeypatch.setattr(blocks, "STRIP", 7)
    rng = np.random.default_rng(13)
    q, x = rng.normal(size=(30, 5)), rng.normal(size=(200, 5))
    x[20:90], q[4] = x[3], 0
    assert search(range(30), q, range(200), x, 4, metric, [60]) == brute_force(range(30), q, range(200), x, 4, metric)
