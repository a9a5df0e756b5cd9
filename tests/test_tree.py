import numpy as np
import pytest
from conftest import brute_force, frame, rows_of
from test_codes import clustered

from shelfmark.operators import tree


@pytest.mark.parametrize("metric,cell_rows", [("l2", 20_000), ("cosine", 20_000), ("l2", 40)])
def test_tree_is_exact(spark, metric, cell_rows):
    rng = np.random.default_rng(1)
    x = clustered(rng, 500, 6)
    x[100:250] = x[9]  # a crowded leaf
    x[7] = 0
    items = frame(spark, "item_id", range(500), x).repartition(4)
    fitted, held = tree.fit_tree(items, 30, metric)
    listed = tree.assign_leaves(held, fitted, cell_rows=cell_rows).checkpoint()
    assert listed.count() == (499 if metric == "cosine" else 500)
    q = np.concatenate([clustered(rng, 40, 6), x[:3]])
    ids = [i % 30 for i in range(len(q))]
    got = tree.knn_tree(frame(spark, "query_id", ids, q), listed, fitted, cell_rows=cell_rows)
    want = brute_force(range(len(q)), q, range(500), x, 5, metric)
    assert sorted(map(tuple, got.collect())) == sorted((ids[i], *rest) for i, *rest in want)


def test_each_item_lies_in_the_nearest_leaf_of_its_top(spark):
    x = clustered(np.random.default_rng(2), 300, 5)
    fitted, held = tree.fit_tree(frame(spark, "item_id", range(300), x), 25)
    leaves = fitted.leaves.collect()
    assert len({r.list_id for r in leaves}) == len(leaves) and all(r.list_id // tree.LEAVES_OF_TOP == r.top for r in leaves)
    for row in tree.assign_leaves(held, fitted).collect():
        gaps = {r.list_id: ((x[row.item_id] - np.array(r.center, np.float32)) ** 2).sum() for r in leaves if r.top == row.top}
        assert abs(min(gaps.values()) - row.list_gap) < 1e-4 and abs(gaps[row.list_id] - row.list_gap) < 1e-4


def test_probes_find_most_and_more_with_more(spark):
    rng = np.random.default_rng(3)
    x, q = clustered(rng, 2000, 8), clustered(rng, 40, 8)
    fitted, held = tree.fit_tree(frame(spark, "item_id", range(2000), x).repartition(4), 100)
    listed = tree.assign_leaves(held, fitted).checkpoint()
    asked = frame(spark, "query_id", range(40), q)
    want = {r[:2] for r in brute_force(range(40), q, range(2000), x, 5)}
    recall = [
        len({r[:2] for r in rows_of(tree.knn_tree(asked, listed, fitted, nprobe=n))} & want) / len(want)
        for n in (1, 10, 40)
    ]
    assert recall == sorted(recall) and recall[-1] >= 0.9


def test_leaves_are_not_broadcast(spark):
    """Neither the fit nor the search holds all leaves' centres in one place."""
    x = clustered(np.random.default_rng(4), 200, 4)
    fitted, held = tree.fit_tree(frame(spark, "item_id", range(200), x), 40)
    plan = tree.assign_leaves(held, fitted)._jdf.queryExecution().executedPlan().toString()
    broadcast = [line for line in plan.splitlines() if "BroadcastExchange" in line]
    assert "FlatMapCoGroupsInArrow" in plan and broadcast and "center" not in "".join(broadcast)


def test_no_queries(spark):
    x = clustered(np.random.default_rng(5), 50, 4)
    fitted, held = tree.fit_tree(frame(spark, "item_id", range(50), x), 9)
    assert tree.knn_tree(frame(spark, "query_id", [], []), tree.assign_leaves(held, fitted), fitted).collect() == []


def test_visits_of_a_part_are_bounded(spark, monkeypatch):
    """Queries under a top are cut so that they cannot all visit all its leaves at once."""
    rng = np.random.default_rng(6)
    x = clustered(rng, 200, 6)
    fitted, held = tree.fit_tree(frame(spark, "item_id", range(200), x), 36)
    listed = tree.assign_leaves(held, fitted).checkpoint()
    most = max(r["count"] for r in fitted.leaves.groupBy("top").count().collect())
    asked, meet = [], tree._meet_leaves
    monkeypatch.setattr(tree, "_PART_VISITS", 30)
    monkeypatch.setattr(tree, "_meet_leaves", lambda *a: asked.append(a[-1]) or meet(*a))
    got = rows_of(tree.knn_tree(frame(spark, "query_id", range(60), x[:60]), listed, fitted))
    assert got == brute_force(range(60), x[:60], range(200), x, 5)
    assert len(asked) == 2 and all(rows * most <= 30 for rows in asked)
