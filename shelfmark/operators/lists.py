"""Nearest items through inverted lists.

K-means centroids cut the items into lists. A query visits only some lists and is
compared exactly with what they hold. ``knn_lists`` visits the ``nprobe`` nearest
lists (approximate, exact when all are visited). ``knn_pruned`` visits every list
that could hold one of the k best, by the triangle inequality, and is exact.

Items and queries meet by an equi-join on (list, item part, query part). A list is
cut into parts of bounded size, so a list that holds a third of the items, or is
visited by a third of the queries, is spread over many tasks.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import config
from shelfmark.functions import vectors as V
from shelfmark.operators.blocks import TopK, placed, vectors_of
from shelfmark.operators.nearest import RESULT, named_again, top_k_rows, with_keys
from shelfmark.session import ensure_checkpoints, share

_log = logging.getLogger(__name__)

#: Queries times lists that are compared at a time, and visits in one Arrow batch.
_VISIT_VALUES = 1 << 20
_VISIT_ROWS = 8192


@dataclass(frozen=True)
class Centroids:
    """The centre of each list; its size does not grow with the items."""

    vectors: np.ndarray
    metric: str = "l2"

    @property
    def ids(self) -> np.ndarray:
        return np.arange(len(self.vectors), dtype=np.int64)

    def __len__(self) -> int:
        return len(self.vectors)


def fit_centroids(
    items: DataFrame,
    lists: int,
    metric: str = "l2",
    *,
    seed: int = 42,
    sweeps: int = 20,
) -> Centroids:
    """K-means centres of all items; a warning says if ``sweeps`` did not suffice.

    The centres only place the lists: results that visit all lists, or that prune,
    do not depend on them. For ``cosine`` vectors are scaled to length one, where
    nearness by distance and by angle agree.
    """
    usable = items.where(F.col("embedding").isNotNull())
    place = V.unit(F.col("embedding")) if metric == "cosine" else F.col("embedding")
    points = usable.select(
        array_to_vector(F.transform(place, lambda x: x.cast("double"))).alias("features")
    )
    model = KMeans(k=max(lists, 2), seed=seed, maxIter=sweeps, initSteps=2).fit(points)
    if model.hasSummary and model.summary.numIter >= sweeps:
        _log.warning("the centres of %d lists still moved after %d sweeps", lists, sweeps)
    centers = np.asarray(model.clusterCenters(), dtype=np.float32)
    if centers.nbytes > config.BROADCAST_BYTES:
        raise ValueError("too many lists: the centroids must fit a broadcast")
    return Centroids(centers, metric)


def assign_lists(items: DataFrame, centroids: Centroids) -> DataFrame:
    """Items with ``list_id``, the nearest list, and ``list_gap``, the squared
    distance to its centre."""
    block = share(items.sparkSession, (centroids.ids, centroids.vectors))
    metric = centroids.metric

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, centers = block.value
        for batch in batches:
            if batch.num_rows:
                rows = np.arange(batch.num_rows, dtype=np.int64)
                best = TopK(rows, placed(batch.column("embedding"), metric), 1, "l2", 9)
                best.add(ids, centers)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(best.item[:, 0]), pa.array(best.cost[:, 0])],
                    names=[*batch.schema.names, "list_id", "list_gap"],
                )

    schema = T.StructType(
        [
            *items.schema.fields,
            T.StructField("list_id", T.LongType()),
            T.StructField("list_gap", T.DoubleType()),
        ]
    )
    return items.where(F.col("embedding").isNotNull()).mapInArrow(run, schema)


def nearest_lists(queries: DataFrame, centroids: Centroids, nprobe: int) -> DataFrame:
    """(query_id, embedding, list_id) for the ``nprobe`` lists nearest a query."""
    block = share(queries.sparkSession, (centroids.ids, centroids.vectors))
    metric = centroids.metric

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, centers = block.value
        for batch in batches:
            if batch.num_rows:
                rows = np.arange(batch.num_rows, dtype=np.int64)
                best = TopK(rows, placed(batch.column("embedding"), metric), nprobe, "l2", 9)
                best.add(ids, centers)
                row, place = np.nonzero(np.isfinite(best.cost))
                picked = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*picked.columns, pa.array(best.item[row, place])],
                    names=["query_id", "embedding", "list_id"],
                )

    source = queries.select(F.col("query_id").cast("bigint"), "embedding")
    return source.where(F.col("embedding").isNotNull()).mapInArrow(
        run, "query_id bigint, embedding array<float>, list_id bigint"
    )


def knn_lists(
    queries: DataFrame,
    listed: DataFrame,
    centroids: Centroids,
    k: int = config.TOP_K,
    *,
    nprobe: int,
    digits: int = config.SCORE_DIGITS,
    cell_rows: int = config.CELL_ROWS,
    broadcast_bytes: int = config.BROADCAST_BYTES,
    query_rows: int | None = None,
) -> DataFrame:
    """The k best items of the ``nprobe`` lists nearest each query.

    ``listed`` is the output of :func:`assign_lists`, or an index that stored it.
    The metric is the one the centroids were fitted for. When the counted visits
    fit a broadcast the items are scanned where they lie; otherwise both sides are
    shuffled into cells.
    """
    nprobe = min(nprobe, len(centroids))
    rows = queries.count() if query_rows is None else query_rows
    keyed, names = with_keys(queries.select("query_id", "embedding"))
    visits = nearest_lists(keyed, centroids, nprobe)
    # A visit holds a vector, and room for its results in each task.
    if rows * nprobe * (4 * centroids.vectors.shape[1] + 16 + 16 * k) <= broadcast_bytes:
        found = _scan_lists(visits, listed, len(centroids), k, centroids.metric, digits)
    else:
        found = search_cells(
            visits, listed, k, centroids.metric, digits=digits, cell_rows=cell_rows
        )
    return named_again(found, names)


def _scan_lists(
    visits: DataFrame, listed: DataFrame, lists: int, k: int, metric: str, digits: int
) -> DataFrame:
    """Scan the visited lists only, against the queries that visit each."""
    table = visits.toArrow()  # size checked by the caller
    queries, at = table.column("query_id").to_numpy(), table.column("list_id").to_numpy()
    vectors = vectors_of(table.column("embedding"))
    visited = {int(n): np.nonzero(at == n)[0] for n in np.unique(at)}
    block = share(
        listed.sparkSession, {n: (queries[rows], vectors[rows]) for n, rows in visited.items()}
    )
    items = listed.select("item_id", "embedding", "list_id")
    if len(visited) < lists:
        items = items.where(F.col("list_id").isin(list(visited)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, TopK] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids, vectors = batch.column(0).to_numpy(), vectors_of(batch.column(1))
            order = np.argsort(batch.column(2).to_numpy(), kind="stable")
            at = batch.column(2).to_numpy()[order]
            for rows in np.split(order, np.nonzero(np.diff(at))[0] + 1):
                n = int(batch.column(2)[int(rows[0])].as_py())
                if n in block.value:
                    if n not in held:
                        held[n] = TopK(*block.value[n], k, metric, digits)
                    held[n].add(ids[rows], vectors[rows])
        for best in held.values():
            yield best.result()

    return top_k_rows(items.mapInArrow(run, RESULT), k, metric)


def knn_pruned(
    queries: DataFrame,
    items: DataFrame,
    k: int = config.TOP_K,
    metric: str = "l2",
    *,
    lists: int | None = None,
    prune: bool | None = None,
    digits: int = config.SCORE_DIGITS,
    cell_rows: int = config.CELL_ROWS,
) -> DataFrame:
    """Exact k nearest items when neither side fits a broadcast.

    A first visit to the nearest list bounds the distance of the k-th best. A list
    is then visited only if its centre is within that bound plus its radius. Where
    that would copy more rows than comparing all blocks of queries with all blocks of
    items (lists hardly prune in many dimensions), the blocks are compared instead.
    """
    spark = queries.sparkSession
    ensure_checkpoints(spark)
    items = items.select(F.col("item_id").cast("bigint"), "embedding")
    if metric == "cosine":
        longer = V.norm(F.col("embedding")) > 0
        queries, items = queries.where(longer), items.where(longer)
    rows = items.count()
    if rows == 0:
        return spark.createDataFrame([], RESULT)
    queries, names = with_keys(queries.where(F.col("embedding").isNotNull()))
    if lists is None:
        dim = items.select(F.size("embedding")).first()[0]
        # As many as the centres may take of a broadcast.
        lists = int(np.clip(np.sqrt(rows), 2, max(2, config.BROADCAST_BYTES // (8 * max(dim, 1)))))
    centroids = fit_centroids(items, lists, metric)
    listed = assign_lists(items, centroids).checkpoint()
    nearest = nearest_lists(queries, centroids, 1)
    first = search_cells(nearest, listed, k, metric, digits=digits, cell_rows=cell_rows)
    gap = 2 - 2 * F.col("score") if metric == "cosine" else F.col("score")
    bound = first.where(F.col("rank") == k).select("query_id", gap.alias("bound"))
    bound = bound.checkpoint()
    radius = listed.groupBy("list_id").agg(F.max("list_gap").alias("radius"))
    bounded = queries.join(bound, "query_id", "left")
    asked, copied = queries.count(), _count_within(bounded, radius, centroids)
    if prune is None:
        query_blocks, item_blocks = -(-asked // cell_rows), -(-rows // cell_rows)
        prune = copied + rows <= asked * item_blocks + rows * query_blocks
    if prune:
        visits = _lists_within(bounded, radius, centroids)
        found = search_cells(visits, listed, k, metric, digits=digits, cell_rows=cell_rows)
    else:
        _log.info("%d visits of %d queries: comparing all blocks", copied, asked)
        found = compare_all(queries, listed, k, metric, digits=digits, cell_rows=cell_rows)
    return named_again(found, names)


def _reach(queries: DataFrame, radius: DataFrame, centroids: Centroids):
    """A function from a batch of ``queries`` (query_id, embedding, bound) to tiles of it:
    (first row, which lists may hold a result of each row), and the lists' ids."""
    held = sorted((row["list_id"], row["radius"]) for row in radius.collect())  # a row per list
    ids = np.array([n for n, _ in held], dtype=np.int64)
    radii = np.sqrt([gap for _, gap in held])
    block = share(queries.sparkSession, (ids, centroids.vectors[ids].astype(np.float64), radii))
    metric = centroids.metric

    def within(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        _, centers, reach = block.value
        squares = np.einsum("ld,ld->l", centers, centers)
        step = max(1, _VISIT_VALUES // max(len(centers), 1))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            q = placed(part.column("embedding"), metric).astype(np.float64)
            gap = np.einsum("nd,nd->n", q, q)[:, None] + squares[None, :] - 2 * (q @ centers.T)
            gap = np.sqrt(np.maximum(gap, 0))
            bound = part.column("bound").to_numpy(zero_copy_only=False).astype(np.float64)
            bound = np.where(np.isnan(bound), np.inf, np.sqrt(np.maximum(bound, 0)))
            # room for rounded bounds and for rounding in the distances
            slack = 2e-3 + 1e-6 * (gap + reach[None, :])
            yield start, gap <= bound[:, None] + reach[None, :] + slack

    return within, ids


def _lists_within(queries: DataFrame, radius: DataFrame, centroids: Centroids) -> DataFrame:
    """(query_id, embedding, list_id) for every list that may hold a result.

    Visits leave a task a few at a time: where lists do not prune there is one for each
    query and list, and each carries a vector.
    """
    within, ids = _reach(queries, radius, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, visited in within(batch):
                row, col = np.nonzero(visited)
                for first in range(0, len(row), _VISIT_ROWS):
                    part = slice(first, first + _VISIT_ROWS)
                    picked = batch.take(pa.array(row[part] + start))
                    yield pa.RecordBatch.from_arrays(
                        [picked.column("query_id"), picked.column("embedding"), pa.array(ids[col[part]])],
                        names=["query_id", "embedding", "list_id"],
                    )

    return queries.where(F.col("embedding").isNotNull()).mapInArrow(
        run, "query_id bigint, embedding array<float>, list_id bigint"
    )


def _count_within(queries: DataFrame, radius: DataFrame, centroids: Centroids) -> int:
    """How many rows :func:`_lists_within` would have, none of them made."""
    within, _ = _reach(queries, radius, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        visits = sum(int(visited.sum()) for batch in batches for _, visited in within(batch))
        yield pa.RecordBatch.from_pydict({"visits": [visits]})

    counted = queries.where(F.col("embedding").isNotNull()).mapInArrow(run, "visits bigint")
    return counted.agg(F.sum("visits")).first()[0] or 0


def compare_all(
    queries: DataFrame, items: DataFrame, k: int, metric: str, *, digits: int, cell_rows: int = config.CELL_ROWS
) -> DataFrame:
    """Every block of queries against every block of items, in one job: nothing is
    broadcast and no cell holds many more than ``cell_rows`` rows of either side."""
    # One list of all; not a literal, so that cells still meet by their keys.
    visits = queries.withColumn("list_id", F.pmod("query_id", F.lit(1)))
    listed = items.withColumn("list_id", F.pmod("item_id", F.lit(1)))
    return search_cells(visits, listed, k, metric, digits=digits, cell_rows=cell_rows)


def search_cells(
    visits: DataFrame,
    listed: DataFrame,
    k: int,
    metric: str,
    *,
    digits: int = config.SCORE_DIGITS,
    cell_rows: int = config.CELL_ROWS,
    few_lists: bool = True,
) -> DataFrame:
    """Compare each query with the items of the lists it visits.

    Lists are cut so that no cell holds many more than ``cell_rows`` rows of
    either side; the other side is copied to each part. ``few_lists`` says that a row for
    each list fits a broadcast.
    """

    def parts(rows: DataFrame, name: str) -> DataFrame:
        size = F.ceil(F.count(F.lit(1)) / F.lit(cell_rows)).cast("int")
        return rows.groupBy("list_id").agg(size.alias(name))

    # One row per list: bounded by the number of centroids.
    cut = parts(listed, "item_parts").join(parts(visits, "query_parts"), "list_id")
    if few_lists:
        cut = F.broadcast(cut)

    def spread(rows: DataFrame, id_col: str, own: str, other: str) -> DataFrame:
        count = F.col(f"{own}_parts").cast("bigint")
        return (
            rows.select("list_id", id_col, "embedding")
            .join(cut, "list_id")
            .withColumn(f"{own}_part", F.pmod(F.xxhash64(id_col), count).cast("int"))
            .withColumn(f"{other}_part", F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1)))
            .select("list_id", "item_part", "query_part", id_col, "embedding")
        )

    cell = ["list_id", "item_part", "query_part"]
    left = spread(visits, "query_id", "query", "item").groupBy(*cell)
    right = spread(listed, "item_id", "item", "query").groupBy(*cell)

    def run(queries: pa.Table, items: pa.Table) -> pa.Table:
        best = TopK(
            queries.column("query_id").to_numpy(),
            vectors_of(queries.column("embedding")),
            k,
            metric,
            digits,
        )
        best.add(items.column("item_id").to_numpy(), vectors_of(items.column("embedding")))
        return pa.Table.from_batches([best.result()])

    return top_k_rows(left.cogroup(right).applyInArrow(run, RESULT), k, metric)
