import numpy as np
import pytest
from conftest import brute_force, frame, rows_of

from shelfmark.operators import lists
from shelfmark.operators.nearest import block_sizes, choose_strategy, knn_exact, ordered

STRATEGIES = ["auto", "items", "queries", "lists"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    q, x = rng.normal(size=(30, 8)), rng.normal(size=(200, 8))
    x[100:170] = x[3]  # a group of copies holds a third of the items
    qids, iids = np.arange(30) * 10, rng.permutation(200)
    return qids, q, iids, x, frame(spark, "query_id", qids, q), frame(spark, "item_id", iids, x)


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("strategy", STRATEGIES)
def test_equals_brute_force(data, strategy, metric):
    qids, q, iids, x, queries, items = data
    got = rows_of(knn_exact(queries, items, 5, metric, strategy=strategy))
    assert got == brute_force(qids, q, iids, x, 5, metric)


@pytest.mark.parametrize("parts", [1, 4, 32])
@pytest.mark.parametrize("strategy", ["items", "queries"])
def test_partitioning_does_not_matter(data, strategy, parts):
    qids, q, iids, x, queries, items = data
    got = rows_of(
        knn_exact(queries.repartition(parts), items.repartition(parts), 5, strategy=strategy)
    )
    assert got == brute_force(qids, q, iids, x, 5)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_more_wanted_than_held(spark, data, strategy):
    qids, q, _, x, queries, _ = data
    items = frame(spark, "item_id", [1, 2, 3], x[:3])
    got = rows_of(knn_exact(queries, items, 10, strategy=strategy))
    assert got == brute_force(qids, q, [1, 2, 3], x[:3], 10)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_empty_sides(data, strategy):
    queries, items = data[4], data[5]
    assert knn_exact(queries, items.where("false"), strategy=strategy).count() == 0
    assert knn_exact(queries.where("false"), items, strategy=strategy).count() == 0


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_equal_queries_each_get_their_answer(spark, data, strategy):
    _, q, iids, x, _, items = data
    q = q[np.arange(30) % 4]
    queries = frame(spark, "query_id", range(30), q)
    got = rows_of(knn_exact(queries, items, 5, strategy=strategy))
    assert got == brute_force(range(30), q, iids, x, 5)


def test_null_vectors_take_no_part(spark, data):
    qids, q, _, x, _, _ = data
    queries = frame(spark, "query_id", [1, 2], [q[0], None])
    items = frame(spark, "item_id", [1, 2, 3], [x[0], None, x[2]])
    got = rows_of(knn_exact(queries, items, 5))
    assert got == brute_force([1], q[:1], [1, 3], x[[0, 2]], 5)


def test_zero_vectors(spark):
    queries = frame(spark, "query_id", [1, 2], [[1.0, 0.0], [0.0, 0.0]])
    items = frame(spark, "item_id", [1, 2], [[0.0, 0.0], [2.0, 0.0]])
    assert rows_of(knn_exact(queries, items, metric="cosine")) == {(1, 2, 1, 1.0)}
    assert len(rows_of(knn_exact(queries, items, metric="l2"))) == 4


def test_wrong_dimension_stops_the_job(spark, data):
    queries = frame(spark, "query_id", [1], [[1.0, 2.0]])
    for strategy in ("items", "queries"):
        with pytest.raises(Exception, match="dimensions"):
            knn_exact(queries, data[5], strategy=strategy).collect()


def test_side_to_broadcast_follows_counted_size(data):
    queries, items = data[4], data[5]
    assert block_sizes(queries, items, 5) == (30 * (40 + 80), 200 * 40)
    assert block_sizes(queries, items, 5, 7, 9) == (7 * 120, 9 * 40)
    assert choose_strategy(3600, 8000, 3600) == "queries"
    assert choose_strategy(8000, 3600, 3600) == "items"
    assert choose_strategy(8000, 3600, 3599) == "lists"
    with pytest.raises(ValueError, match="unknown"):
        knn_exact(queries, items, strategy="guess")
    with pytest.raises(ValueError, match="items are too large"):
        knn_exact(queries, items, strategy="items", broadcast_bytes=100)


@pytest.mark.parametrize("how", [
    {"strategy": "items"}, {"strategy": "queries"}, {"strategy": "queries", "broadcast_bytes": 1024},
    {"strategy": "lists"}, {"broadcast_bytes": 1024},
])
def test_repeated_query_ids_are_answered_each(spark, how):
    rng = np.random.default_rng(3)
    asked, held = rng.normal(size=(24, 6)), rng.normal(size=(60, 6))
    items = frame(spark, "item_id", range(60), held)
    queries = frame(spark, "query_id", [i % 5 for i in range(24)], asked)
    got = sorted(tuple(r) for r in knn_exact(queries, items, 4, **how).collect())
    want = sorted(
        (i % 5, *row[1:]) for i in range(24) for row in brute_force([i], asked[i : i + 1], range(60), held, 4)
    )
    assert got == want


def test_item_search_has_no_shuffle(data):
    queries, items = data[4], data[5]
    plan = knn_exact(queries, items, strategy="items")._jdf.queryExecution().toString()
    assert "Exchange" not in plan
    plan = knn_exact(queries, items, strategy="queries")._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_reading_order(data):
    rows = ordered(knn_exact(data[4], data[5], 3)).collect()
    assert [(r.query_id, r["rank"]) for r in rows] == sorted((r.query_id, r["rank"]) for r in rows)


def test_many_small_blocks_are_compared_in_one_job(spark):
    """A job and a scan of the items for each block would grow with the square of the rows."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 6))
    queries, items = frame(spark, "query_id", range(60), x), frame(spark, "item_id", range(60), x)
    context = spark.sparkContext
    context.setJobGroup("blocks", "")
    try:
        got = rows_of(knn_exact(queries, items, 4, strategy="queries", broadcast_bytes=100))
        jobs = context.statusTracker().getJobIdsForGroup("blocks")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert got == brute_force(range(60), x, range(60), x, 4) and 0 < len(jobs) < 30


def test_no_lists_are_fitted_for_a_few_blocks(spark, monkeypatch):
    """Neither side fits, but a few scans cost less than fitting and visiting lists."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(40, 6))
    queries, items = frame(spark, "query_id", range(40), x), frame(spark, "item_id", range(40), x)
    monkeypatch.setattr(lists, "knn_pruned", None)
    assert rows_of(knn_exact(queries, items, 4, broadcast_bytes=1000)) == brute_force(range(40), x, range(40), x, 4)
    with pytest.raises(TypeError):
        knn_exact(queries, items, 4, broadcast_bytes=100)


def test_no_lists_are_fitted_for_blocks_of_a_large_batch(spark, monkeypatch):
    """Requests of 6 GB take twenty blocks: lists that do not prune would copy each side for each block of the other."""
    rng = np.random.default_rng(10)
    x = rng.normal(size=(40, 6))
    queries, items = frame(spark, "query_id", range(40), x), frame(spark, "item_id", range(40), x)
    monkeypatch.setattr(lists, "knn_pruned", None)
    assert rows_of(knn_exact(queries, items, 4, broadcast_bytes=192)) == brute_force(range(40), x, range(40), x, 4)
