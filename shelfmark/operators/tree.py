"""Nearest items through lists of lists.

With many lists their centres are as large a problem as the items: finding the nearest of
a million centres costs as much as searching a million items, and they do not fit a
broadcast. Here the lists are the leaves of a tree of two levels. A few hundred or
thousand tops are fitted by k-means on a bounded sample and broadcast; each top's leaves
are fitted on a bounded sample of the items it holds, all tops side by side, and stay a
table. Rows meet only the leaves of the tops they visit, in a co-group that is cut where
a top is crowded.

``knn_tree`` visits the nearest leaves of the nearest tops (``nprobe``), or, without it,
every leaf that could hold one of the k best: a first visit bounds the k-th distance, the
triangle inequality drops tops by their radius, then leaves by theirs. That is exact.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark import config
from shelfmark.functions import vectors as V
from shelfmark.operators.blocks import TopK, placed, vectors_of
from shelfmark.operators.lists import (
    Centroids, _lists_within, assign_lists, fit_centroids, nearest_lists, search_cells,
)
from shelfmark.operators.nearest import named_again, with_keys
from shelfmark.session import ensure_checkpoints

#: Items that the tops are fitted on, about, and items for each leaf of a top, at most.
TOP_SAMPLE = 1 << 18
LEAF_SAMPLE = 64
#: Leaves of a top are numbered from its number times this.
LEAVES_OF_TOP = 1 << 20
_FRACTION = 1 << 30
_SWEEPS = 10
#: Leaves that bound a query's k-th distance.
_FIRST_LEAVES = 4
#: Visits that one part of a top's queries may make.
_PART_VISITS = 1 << 15

_LEAVES = "list_id bigint, top bigint, center array<float>"


@dataclass(frozen=True)
class Tree:
    """``tops`` fit a broadcast; ``leaves`` (list_id, top, center) are a written table."""

    tops: Centroids
    leaves: DataFrame


def _drawn(seed: int, share: Column | int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), "item_id"), F.lit(_FRACTION)) < share


def _with_top(items: DataFrame, tops: Centroids) -> DataFrame:
    listed = assign_lists(items.select(F.col("item_id").cast("bigint").alias("item_id"), "embedding"), tops)
    return listed.withColumnsRenamed({"list_id": "top", "list_gap": "top_gap"})


def fit_tree(items: DataFrame, lists: int, metric: str = "l2", *, seed: int = 42) -> tuple[Tree, DataFrame]:
    """A tree of about ``lists`` leaves, and the items with the ``top`` each lies under.

    Both are written to the shared folder. Results that prune do not depend on the fit.
    """
    ensure_checkpoints(items.sparkSession)
    items = items.where(F.col("embedding").isNotNull())
    if metric == "cosine":
        items = items.where(V.norm(F.col("embedding")) > 0)
    rows = items.count()
    wanted = max(2, round(lists**0.5))
    sample = items if rows <= TOP_SAMPLE else items.where(_drawn(seed, int(_FRACTION * TOP_SAMPLE / rows)))
    tops = fit_centroids(sample.select("item_id", "embedding"), wanted, metric, seed=seed)
    placed_items = _with_top(items, tops).checkpoint()
    each = -(-lists // len(tops))
    held = placed_items.groupBy("top").agg(F.count(F.lit(1)).alias("held"))
    # One row for each top.
    share = F.least(F.lit(_FRACTION), F.lit(_FRACTION * LEAF_SAMPLE * each) / F.col("held"))
    drawn = placed_items.join(F.broadcast(held.select("top", share.alias("share"))), "top")
    drawn = drawn.where(_drawn(seed + 1, F.col("share"))).select("top", "item_id", "embedding")

    def fit(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("item_id").to_numpy(), kind="stable")
        points = placed(table.column("embedding").combine_chunks(), metric)[order].astype(np.float64)
        centres = _centres(points, each, np.random.default_rng(seed))
        top = table.column("top")[0].as_py()
        return pa.table(
            {
                "list_id": pa.array(top * LEAVES_OF_TOP + np.arange(len(centres))),
                "top": pa.array(np.full(len(centres), top, np.int64)),
                "center": pa.array(list(centres.astype(np.float32)), pa.list_(pa.float32())),
            }
        )

    leaves = drawn.groupBy("top").applyInArrow(fit, _LEAVES)
    return Tree(tops, leaves.checkpoint()), placed_items


def _centres(points: np.ndarray, wanted: int, random: np.random.Generator) -> np.ndarray:
    """K-means centres of a bounded sample, no more than it has different points."""
    points_once = np.unique(points, axis=0)
    if len(points_once) <= wanted:
        return points_once
    centres = points_once[np.sort(random.choice(len(points_once), wanted, replace=False))]
    squares = np.einsum("nd,nd->n", points, points)
    for _ in range(_SWEEPS):
        gap = squares[:, None] + np.einsum("cd,cd->c", centres, centres)[None, :] - 2 * (points @ centres.T)
        nearest = gap.argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.stack([np.bincount(nearest, points[:, d], len(centres)) for d in range(points.shape[1])], axis=1)
        moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres


def _meet_leaves(
    rows: DataFrame, leaves: DataFrame, id_col: str, run: Callable[[pa.Table, pa.Table], pa.Table], schema: str, cell_rows: int
) -> DataFrame:
    """``run`` on the rows under each top and the top's leaves; the rows of a crowded top
    are cut into parts, which all get the leaves."""
    parts = rows.groupBy("top").agg(F.ceil(F.count(F.lit(1)) / F.lit(cell_rows)).cast("int").alias("parts"))
    # One row for each top.
    dealt = rows.join(F.broadcast(parts), "top")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64(id_col), F.col("parts").cast("bigint")).cast("int")).drop("parts")
    given = leaves.join(F.broadcast(parts), "top").select(
        F.col("top").alias("of_top"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("of_part"),
        *(c for c in leaves.columns if c != "top"),
    )
    return dealt.groupBy("top", "part").cogroup(given.groupBy("of_top", "of_part")).applyInArrow(run, schema)


def assign_leaves(placed_items: DataFrame, tree: Tree, *, cell_rows: int = config.CELL_ROWS) -> DataFrame:
    """(item_id, embedding, top, top_gap, list_id, list_gap): the nearest leaf under each
    item's top, and the squared distances to both."""
    metric = tree.tops.metric
    kept = ("item_id", "embedding", "top", "top_gap")

    def run(rows: pa.Table, leaves: pa.Table) -> pa.Table:
        found = rows.select(kept)
        list_id, gap = np.zeros(0, np.int64), np.zeros(0)
        if rows.num_rows:
            vectors = placed(rows.column("embedding").combine_chunks(), metric)
            best = TopK(np.arange(rows.num_rows), vectors, 1, "l2", 9)
            best.add(leaves.column("list_id").to_numpy(), vectors_of(leaves.column("center")))
            list_id, gap = best.item[:, 0], best.cost[:, 0]
        return found.append_column("list_id", pa.array(list_id)).append_column("list_gap", pa.array(gap))

    schema = "item_id bigint, embedding array<float>, top bigint, top_gap double, list_id bigint, list_gap double"
    return _meet_leaves(placed_items.select(*kept), tree.leaves, "item_id", run, schema, cell_rows)


_VISITS = "query_id bigint, embedding array<float>, list_id bigint, gap double"


def _visits(asked: DataFrame, leaves: DataFrame, metric: str, nprobe: int | None, cell_rows: int) -> DataFrame:
    """Leaves under the tops of ``asked`` (query_id, embedding, top, bound): the ``nprobe``
    nearest, or those that may hold an item within the bound."""

    def run(rows: pa.Table, leaves: pa.Table) -> pa.Table:
        n, m = rows.num_rows, leaves.num_rows
        if not n or not m:
            row = col = np.zeros(0, np.int64)
            gap = np.zeros((n, m))
        else:
            q = placed(rows.column("embedding").combine_chunks(), metric).astype(np.float64)
            centres = vectors_of(leaves.column("center")).astype(np.float64)
            gap = np.einsum("nd,nd->n", q, q)[:, None] + np.einsum("ld,ld->l", centres, centres)[None, :]
            gap = np.sqrt(np.maximum(gap - 2 * (q @ centres.T), 0))
            if nprobe is None:
                reach = np.sqrt(leaves.column("radius").to_numpy())
                bound = rows.column("bound").to_numpy().astype(np.float64)
                bound = np.where(np.isnan(bound), np.inf, np.sqrt(np.maximum(bound, 0)))
                # room for rounded bounds and for rounding in the distances
                slack = 2e-3 + 1e-6 * (gap + reach[None, :])
                row, col = np.nonzero(gap <= bound[:, None] + reach[None, :] + slack)
            else:
                near = np.argsort(gap, axis=1, kind="stable")[:, :nprobe]
                row, col = np.repeat(np.arange(n), near.shape[1]), near.ravel()
        picked = rows.take(pa.array(row)).select(["query_id", "embedding"])
        picked = picked.append_column("list_id", pa.array(leaves.column("list_id").to_numpy()[col], pa.int64()))
        return picked.append_column("gap", pa.array(gap[row, col], pa.float64()))

    # Each visit carries a vector, and all of a part leave it at once.
    most = leaves.groupBy("top").count().agg(F.max("count")).first()[0] or 1
    found = _meet_leaves(asked, leaves, "query_id", run, _VISITS, max(1, min(cell_rows, _PART_VISITS // most)))
    if nprobe is not None:
        place = F.row_number().over(Window.partitionBy("query_id").orderBy("gap", "list_id"))
        found = found.withColumn("place", place).where(F.col("place") <= nprobe)
    return found.select("query_id", "embedding", "list_id")


def knn_tree(
    queries: DataFrame,
    listed: DataFrame,
    tree: Tree,
    k: int = config.TOP_K,
    *,
    nprobe: int | None = None,
    top_probes: int = 8,
    digits: int = config.SCORE_DIGITS,
    cell_rows: int = config.CELL_ROWS,
) -> DataFrame:
    """The k nearest items of each query; ``listed`` is what :func:`assign_leaves` wrote.

    Exact without ``nprobe``; with it, the ``nprobe`` nearest leaves of the ``top_probes``
    nearest tops are visited. Query ids may repeat.
    """
    ensure_checkpoints(queries.sparkSession)
    metric = tree.tops.metric
    queries = queries.where(F.col("embedding").isNotNull())
    if metric == "cosine":
        queries = queries.where(V.norm(F.col("embedding")) > 0)
    keyed, names = with_keys(queries.select("query_id", "embedding"))
    no_bound = F.lit(None).cast("double").alias("bound")

    def search(visits: DataFrame) -> DataFrame:
        return search_cells(visits, listed, k, metric, digits=digits, cell_rows=cell_rows, few_lists=False)

    if nprobe is not None:
        near = nearest_lists(keyed, tree.tops, min(top_probes, len(tree.tops)))
        asked = near.select("query_id", "embedding", F.col("list_id").alias("top"), no_bound)
        return named_again(search(_visits(asked, tree.leaves, metric, nprobe, cell_rows)), names)
    near = nearest_lists(keyed, tree.tops, 1)
    asked = near.select("query_id", "embedding", F.col("list_id").alias("top"), no_bound)
    first = search(_visits(asked, tree.leaves, metric, _FIRST_LEAVES, cell_rows))
    gap = 2 - 2 * F.col("score") if metric == "cosine" else F.col("score")
    bound = first.where(F.col("rank") == k).select("query_id", gap.alias("bound"))
    bounded = keyed.join(bound, "query_id", "left").checkpoint()
    leaf_radius = listed.groupBy("list_id").agg(F.max("list_gap").alias("radius"))
    leaves = tree.leaves.join(leaf_radius, "list_id")
    # A top reaches as far as its farthest item; one row for each.
    reach = listed.groupBy(F.col("top").alias("list_id")).agg(F.max("top_gap").alias("radius"))
    tops = _lists_within(bounded, reach, tree.tops)
    asked = tops.select("query_id", "embedding", F.col("list_id").alias("top")).join(
        bounded.select("query_id", "bound"), "query_id"
    )
    return named_again(search(_visits(asked, leaves, metric, None, cell_rows)), names)
