import glob
import tracemalloc

import numpy as np
import pytest
from conftest import brute_force, frame, rows_of

from shelfmark.operators import codes, lists
from shelfmark.session import work_root


def clustered(rng, rows, dim):
    centres = rng.normal(size=(6, dim)) * 3
    return (centres[rng.integers(0, 6, rows)] + rng.normal(size=(rows, dim))).astype(np.float32)


def coded(spark, x, metric="l2", parts=3, n_codes=16, lists_of=4):
    items = frame(spark, "item_id", range(len(x)), x).repartition(4)
    centroids = lists.fit_centroids(items, lists_of, metric)
    listed = lists.assign_lists(items, centroids)
    book = codes.fit_codes(listed, centroids, parts=parts, codes=n_codes, sweeps=4)
    return items, codes.encode_items(listed, book), book


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_bounds_lose_nothing(spark, metric):
    rng = np.random.default_rng(1)
    x = clustered(rng, 400, 10)
    x[40:140] = x[3]  # copies
    x[7] = 0
    items, held, book = coded(spark, x, metric)
    q = np.concatenate([clustered(rng, 30, 10), x[:5]])
    ids = [i % 20 for i in range(len(q))]
    asked = frame(spark, "query_id", ids, q).repartition(3)
    want = brute_force(range(len(q)), q, range(len(x)), x, 5, metric)
    want = sorted((ids[qid], item, rank, score) for qid, item, rank, score in want)
    for room in (1 << 26, 40_000):
        got = codes.knn_codes(asked, held, items, book, broadcast_bytes=room)
        assert sorted(map(tuple, got.collect())) == want


def test_probes_are_those_of_lists(spark):
    rng = np.random.default_rng(2)
    x, q = clustered(rng, 300, 8), clustered(rng, 25, 8)
    items, held, book = coded(spark, x, parts=4)
    asked = frame(spark, "query_id", range(25), q)
    listed = lists.assign_lists(items, book.lists)
    for nprobe in (1, 2):
        want = rows_of(lists.knn_lists(asked, listed, book.lists, nprobe=nprobe))
        assert rows_of(codes.knn_codes(asked, held, items, book, nprobe=nprobe)) == want


def test_few_ranked_items_find_most(spark):
    rng = np.random.default_rng(3)
    x, q = clustered(rng, 2000, 16), clustered(rng, 50, 16)
    items, held, book = coded(spark, x, parts=8, n_codes=64)
    asked = frame(spark, "query_id", range(50), q)
    want = {r[:2] for r in brute_force(range(50), q, range(2000), x, 5)}
    recall = []
    for rerank in (5, 20, 60):
        found = {tuple(r)[:2] for r in codes.knn_codes(asked, held, items, book, rerank=rerank).collect()}
        recall.append(len(found & want) / len(want))
    assert recall == sorted(recall) and recall[-1] >= 0.9
    with pytest.raises(ValueError, match="results are asked for"):
        codes.knn_codes(asked, held, items, book, rerank=2)


def test_codes_stand_for_near_vectors(spark):
    x = clustered(np.random.default_rng(4), 500, 12)
    _, held, book = coded(spark, x, parts=6, n_codes=32)
    for row in held.collect():
        near = book.decoded(np.frombuffer(row.codes, np.uint8)[None, :])[0][:12] + book.lists.vectors[row.list_id]
        gap = np.linalg.norm(x[row.item_id] - near)
        assert abs(gap - row.error) < 1e-5 and gap < np.linalg.norm(x[row.item_id] - book.lists.vectors[row.list_id])


def test_small_inputs(spark):
    x = np.array([[1.0, 2.0, 3.0]], np.float32)
    items = frame(spark, "item_id", [0], x)
    listed = lists.assign_lists(items, lists.Centroids(x))
    book = codes.fit_codes(listed, lists.Centroids(x), parts=2)
    held = codes.encode_items(listed, book)
    none = frame(spark, "query_id", [], [])
    assert codes.knn_codes(none, held, items, book).collect() == []
    asked = frame(spark, "query_id", [1], [[1.0, 2.0, 5.0]])
    assert rows_of(codes.knn_codes(asked, held, items, book)) == {(1, 0, 1, 4.0)}
    assert codes.knn_codes(asked, held.where("false"), items, book).collect() == []


@pytest.mark.parametrize("rerank", [None, 10])
def test_memory_of_a_task_does_not_grow_with_the_block(rerank):
    """Queries meet items tile by tile, not the whole block at once."""
    rng = np.random.default_rng(5)
    q, x = rng.normal(size=(12_000, 4)).astype(np.float32), rng.normal(size=(8192, 4)).astype(np.float32)
    book = codes.CodeBook(lists.Centroids(np.zeros((1, 4), np.float32)), rng.normal(size=(2, 16, 2)))
    list_ids = np.zeros(len(x), np.int64)
    coded = book.codes(x.astype(np.float64))
    error = np.linalg.norm(x - book.stands(coded, list_ids), axis=1)
    best = (codes._Bounded if rerank is None else codes._Reranked)(np.arange(len(q)), q, None, book, rerank or 5, 6)
    tracemalloc.start()
    best.add_coded(np.arange(len(x)), x, list_ids, coded, error)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6 < 8 * len(q) * len(x)


def test_codes_that_tell_nothing_apart_pass_on_few_rows(spark):
    """Every item could be among the best of every query; a task still passes on k."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 6)).astype(np.float32)
    items = frame(spark, "item_id", range(300), x)
    origin = lists.Centroids(np.zeros((1, 6), np.float32))
    book = codes.CodeBook(origin, np.zeros((2, 1, 3)))
    held = codes.encode_items(lists.assign_lists(items, origin), book)
    before = set(glob.glob(f"{work_root(spark)}/codes-*/block=*"))
    got = rows_of(codes.knn_codes(frame(spark, "query_id", range(300), x), held, items, book, broadcast_bytes=8192))
    assert got == brute_force(range(300), x, range(300), x, 5)
    written = sorted(set(glob.glob(f"{work_root(spark)}/codes-*/block=*")) - before)
    assert len(written) > 1 and spark.read.parquet(*written).count() == 300 * 5


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_ranking_every_item_is_exact(spark, metric):
    rng = np.random.default_rng(7)
    x = clustered(rng, 200, 10)
    x[40:60] = x[3]
    items, held, book = coded(spark, x, metric)
    asked = frame(spark, "query_id", range(40), x[:40]).repartition(3)
    for room in (1 << 26, 16_000):
        got = rows_of(codes.knn_codes(asked, held, items, book, rerank=200, broadcast_bytes=room))
        assert got == brute_force(range(40), x[:40], range(200), x, 5, metric)


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_items_that_codes_cannot_bar_are_screened_by_their_vectors(monkeypatch, metric):
    """Codes that tell nothing apart name every item; a product in double of each is not needed."""
    rng = np.random.default_rng(8)
    x, q = rng.normal(size=(3000, 6)).astype(np.float32), rng.normal(size=(40, 6)).astype(np.float32)
    book = codes.CodeBook(lists.Centroids(np.zeros((1, 6), np.float32), metric), np.zeros((2, 1, 3)))
    list_ids, ids = np.zeros(len(x), np.int64), rng.permutation(len(x))
    placed = x / np.linalg.norm(x, axis=1, keepdims=True) if metric == "cosine" else x
    coded, error = book.codes(placed.astype(np.float64)), np.linalg.norm(placed.astype(np.float64), axis=1)
    ranked = []
    whole = codes.TopK._rescore
    monkeypatch.setattr(codes.TopK, "_best_of_crowd", None)
    monkeypatch.setattr(codes.TopK, "_rescore", lambda self, row, *a: ranked.append(len(row)) or whole(self, row, *a))
    best = codes._Bounded(np.arange(len(q)), q, None, book, 5, 6)
    for part in np.split(np.arange(len(x)), [1200]):
        best.add_coded(ids[part], x[part], list_ids[part], coded[part], error[part])
    got = {tuple(r.values()) for r in best.result().to_pylist()}
    assert got == brute_force(range(len(q)), q, ids, x, 5, metric) and sum(ranked) < len(q) * len(x) / 50


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_reranked_queries_go_from_block_to_block_of_items(spark, monkeypatch, metric):
    """A row for each ranked item, query and task would be sorted; what a query holds goes with it."""
    rng = np.random.default_rng(9)
    x = clustered(rng, 260, 10)
    x[40:60] = x[3]
    items, held, book = coded(spark, x, metric)
    asked = frame(spark, "query_id", [i % 50 for i in range(60)], x[:60]).repartition(3)
    want = brute_force(range(60), x[:60], range(260), x, 5, metric)
    few = codes.knn_codes(asked.where("query_id < 4"), held, items, book, rerank=12, nprobe=2).collect()
    monkeypatch.setattr(codes, "top_k_rows", None)
    before = set(glob.glob(f"{work_root(spark)}/codes-*/held=*"))
    got = codes.knn_codes(asked, held, items, book, rerank=260, broadcast_bytes=6_000)
    assert sorted(map(tuple, got.collect())) == sorted((q % 50, *row) for q, *row in want)
    assert len(set(glob.glob(f"{work_root(spark)}/codes-*/held=*")) - before) > 1
    some = codes.knn_codes(asked, held, items, book, rerank=12, nprobe=2, broadcast_bytes=6_000)
    assert sorted(map(tuple, some.where("query_id < 4").collect())) == sorted(map(tuple, few))


def test_only_what_is_held_is_scored(monkeypatch):
    rng = np.random.default_rng(10)
    q, x = rng.normal(size=(20, 4)).astype(np.float32), rng.normal(size=(20_000, 4)).astype(np.float32)
    book = codes.CodeBook(lists.Centroids(np.zeros((1, 4), np.float32)), rng.normal(size=(2, 16, 2)))
    list_ids, scored, whole = np.zeros(len(x), np.int64), [], codes._Reranked._scores
    monkeypatch.setattr(codes._Reranked, "_scores", lambda self, a, b: scored.append(len(a)) or whole(self, a, b))
    best = codes._Reranked(np.arange(len(q)), q, None, book, 30, 6)
    coded = book.codes(x.astype(np.float64))
    best.add_coded(np.arange(len(x)), x, list_ids, coded, np.zeros(len(x)))
    assert sum(scored) == 30 * len(q)
    near = np.round(((q[:, None].astype(float) - book.stands(coded, list_ids)[None]) ** 2).sum(axis=2), 9)
    order = np.lexsort((np.broadcast_to(np.arange(len(x)), near.shape), near), axis=1)[:, :30]
    assert np.array_equal(np.sort(best.item, axis=1), np.sort(order, axis=1))
