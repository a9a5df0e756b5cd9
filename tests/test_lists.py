import numpy as np
import pytest
from conftest import brute_force, frame, rows_of
from pyspark.sql import functions as F

from shelfmark.operators import lists


@pytest.fixture(scope="module", params=["l2", "cosine"])
def data(spark, request):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(6, 8)) * 4
    x = centers[rng.integers(0, 6, 240)] + rng.normal(size=(240, 8))
    x[80:160] = x[0]  # one list holds more than a third
    q = centers[rng.integers(0, 6, 40)] + rng.normal(size=(40, 8))
    q[10:25] = q[0]  # and a third of the queries visit the same lists
    queries, items = frame(spark, "query_id", range(40), q), frame(spark, "item_id", range(240), x)
    centroids = lists.fit_centroids(items, 6, request.param)
    listed = lists.assign_lists(items, centroids).cache()
    return q, x, queries, items, listed, centroids, request.param


def test_every_item_is_in_its_nearest_list(data):
    _, x, _, _, listed, centroids, metric = data
    rows = listed.select("item_id", "list_id", "list_gap").collect()
    assert len(rows) == 240
    points = x / np.linalg.norm(x, axis=1, keepdims=True) if metric == "cosine" else x
    gaps = ((points[:, None] - centroids.vectors[None]) ** 2).sum(-1)
    for r in rows:
        assert abs(gaps[r.item_id].min() - r.list_gap) < 1e-3


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
@pytest.mark.parametrize("cell_rows", [7, 1000])
def test_all_lists_visited_is_exact(data, broadcast_bytes, cell_rows):
    q, x, queries, _, listed, centroids, metric = data
    found = lists.knn_lists(
        queries, listed, centroids, 5, nprobe=6, cell_rows=cell_rows, broadcast_bytes=broadcast_bytes
    )
    assert rows_of(found) == brute_force(range(40), q, range(240), x, 5, metric)


@pytest.mark.parametrize("nprobe", [1, 2])
def test_scan_and_cells_agree(data, nprobe):
    _, _, queries, _, listed, centroids, _ = data
    scan = lists.knn_lists(queries, listed, centroids, 5, nprobe=nprobe)
    cells = lists.knn_lists(queries, listed, centroids, 5, nprobe=nprobe, cell_rows=9, broadcast_bytes=0)
    assert rows_of(scan) == rows_of(cells)


def test_pruned_search_is_exact(data):
    q, x, queries, items, _, _, metric = data
    for k, cell_rows in ((5, 11), (100, 1000)):
        found = lists.knn_pruned(queries, items, k, metric, lists=6, cell_rows=cell_rows)
        assert rows_of(found) == brute_force(range(40), q, range(240), x, k, metric)


def test_pruned_search_skips_far_lists(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(50, 4)) + 100 * n for n in range(4)])
    items = frame(spark, "item_id", range(200), x)
    queries = frame(spark, "query_id", range(5), x[:5])
    centroids = lists.fit_centroids(items, 4)
    listed = lists.assign_lists(items, centroids)
    radius = listed.groupBy("list_id").agg(F.max("list_gap").alias("radius"))
    bounded = queries.withColumn("bound", F.lit(4.0))
    assert lists._lists_within(bounded, radius, centroids).count() == 5
    unbounded = queries.withColumn("bound", F.lit(None).cast("double"))
    held = listed.select("list_id").distinct().count()
    assert lists._lists_within(unbounded, radius, centroids).count() == 5 * held


def test_cells_stay_small(data):
    _, _, queries, _, listed, centroids, _ = data
    visits = lists.nearest_lists(queries, centroids, 6)
    plan = lists.search_cells(visits, listed, 5, "l2", cell_rows=10)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_visits_are_counted_before_any_is_made(spark, monkeypatch):
    """In many dimensions lists do not prune: no query is copied to each list first."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 30)).astype(np.float32)
    items, queries = frame(spark, "item_id", range(300), x), frame(spark, "query_id", range(300), x)
    centroids = lists.fit_centroids(items, 12)
    radius = lists.assign_lists(items, centroids).groupBy("list_id").agg(F.max("list_gap").alias("radius"))
    monkeypatch.setattr(lists, "_VISIT_VALUES", 100)
    monkeypatch.setattr(lists, "_VISIT_ROWS", 7)
    for bound in (0.01, 20.0, None):
        bounded = queries.withColumn("bound", F.lit(bound).cast("double"))
        made = lists._lists_within(bounded, radius, centroids)
        assert lists._count_within(bounded, radius, centroids) == made.count() == made.distinct().count() > 0
    monkeypatch.setattr(lists, "_lists_within", None)
    assert rows_of(lists.knn_pruned(queries, items, 5, lists=12)) == brute_force(range(300), x, range(300), x, 5)
