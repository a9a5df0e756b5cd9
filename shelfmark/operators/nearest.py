"""Exact k nearest items for every query.

Queries are (query_id bigint, embedding array<float>) and items are
(item_id bigint, embedding array<float>). Item ids are unique. Query ids may repeat:
each query row is answered for itself, under its id, whatever the strategy. The
result is (query_id, item_id, rank, score). The score of ``l2`` is the squared
distance, smaller is better; the score of ``cosine`` is the similarity, larger is
better. A side may be broadcast only after its size has been counted:

* ``items``: the items fit, so every query is answered where it lies, with no
  shuffle at all;
* ``queries``: the queries fit, so the items are scanned once and each task
  passes on its k best per query. Queries beyond the size go block by block, or, if
  these were more than ``MOST_SCANS``, are compared with the items in bounded cells;
* ``lists``: neither fits, and the queries would take more than ``MOST_SCANS`` blocks,
  so both are cut into bounded cells (see :mod:`shelfmark.operators.lists`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark import config
from shelfmark.operators.blocks import TopK, best_of_block, prepared, same_vectors, vectors_of
from shelfmark.session import ensure_checkpoints, new_work_dir, released, share

RESULT = "query_id bigint, item_id bigint, rank bigint, score double"

#: Most blocks of queries that are answered one after another, a scan of the items for
#: each. Fitting lists takes about as many scans, and visiting them where they do not
#: prune copies each side once per block of the other.
MOST_SCANS = 32


def knn_exact(
    queries: DataFrame,
    items: DataFrame,
    k: int = config.TOP_K,
    metric: str = "l2",
    *,
    digits: int = config.SCORE_DIGITS,
    strategy: str = "auto",
    broadcast_bytes: int = config.BROADCAST_BYTES,
    query_rows: int | None = None,
    item_rows: int | None = None,
    dim: int | None = None,
) -> DataFrame:
    """The ``k`` nearest items of every query.

    ``query_rows``, ``item_rows`` and ``dim`` save a job each when the caller
    knows them. Strategy ``items`` is refused if the items do not fit.
    """
    queries = queries.select(F.col("query_id").cast("bigint"), "embedding").where(
        F.col("embedding").isNotNull()
    )
    items = items.select(F.col("item_id").cast("bigint"), "embedding").where(
        F.col("embedding").isNotNull()
    )
    if strategy not in ("auto", "items", "queries", "lists"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy != "lists":
        sizes = block_sizes(queries, items, k, query_rows, item_rows, dim)
        if strategy == "auto":
            strategy = choose_strategy(*sizes, broadcast_bytes)
            if strategy == "lists" and sizes[0] <= MOST_SCANS * broadcast_bytes:
                strategy = "queries"
        elif strategy == "items" and sizes[1] > broadcast_bytes:
            raise ValueError("the items are too large to broadcast")
    if strategy == "items":
        return _search_items_block(queries, items, k, metric, digits)
    if strategy == "queries":
        blocks = -(-sizes[0] // max(broadcast_bytes, 1))
        if blocks > MOST_SCANS:
            from shelfmark.operators.lists import compare_all

            keyed, names = with_keys(queries)
            return named_again(compare_all(keyed, items, k, metric, digits=digits), names)
        if blocks > 1:
            return _search_blocks(queries, items, k, metric, digits, blocks)
        return _search_queries_block(queries, items, k, metric, digits)
    from shelfmark.operators.lists import knn_pruned

    return knn_pruned(queries, items, k, metric, digits=digits)


def block_sizes(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    query_rows: int | None = None,
    item_rows: int | None = None,
    dim: int | None = None,
) -> tuple[int, int]:
    """Bytes of all queries, with room for their results, and of all items."""
    if dim is None:
        first = items.select(F.size("embedding")).first()
        dim = 0 if first is None else first[0]
    row_bytes = 4 * dim + 8
    query_rows = queries.count() if query_rows is None else query_rows
    item_rows = items.count() if item_rows is None else item_rows
    return (row_bytes + 16 * k) * query_rows, row_bytes * item_rows


def choose_strategy(query_bytes: int, item_bytes: int, broadcast_bytes: int) -> str:
    """Name the side to broadcast; the smaller if both fit, ``lists`` if none does."""
    if min(query_bytes, item_bytes) > broadcast_bytes:
        return "lists"
    return "items" if item_bytes <= query_bytes else "queries"


def collect_block(df: DataFrame, id_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a frame whose size the caller has checked."""
    table = df.select(id_col, "embedding").toArrow()
    return table.column(id_col).to_numpy(), vectors_of(table.column("embedding"))


def top_k_rows(candidates: DataFrame, k: int, metric: str) -> DataFrame:
    """Merge partial results: at most ``k`` per query leave each map task."""
    best = F.col("score").desc() if metric == "cosine" else F.col("score").asc()
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(best, "item_id"))
    return (
        candidates.withColumn("rank", place.cast("bigint"))
        .where(F.col("rank") <= k)
        .select("query_id", "item_id", "rank", "score")
    )


def ordered(results: DataFrame) -> DataFrame:
    """Results in reading order: by query, best first."""
    return results.orderBy("query_id", "rank")


def _search_items_block(queries, items, k, metric, digits) -> DataFrame:
    block = share(queries.sparkSession, collect_block(items, "item_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                if held is None:
                    held = prepared(*block.value, k)
                ids, vectors = batch.column(0).to_numpy(), vectors_of(batch.column(1))
                yield from best_of_block(ids, vectors, held, k, metric, digits)

    return queries.mapInArrow(run, RESULT)


def _search_queries_block(queries, items, k, metric, digits) -> DataFrame:
    spark = queries.sparkSession
    ids, vectors = collect_block(queries, "query_id")
    labels = same_vectors(vectors)
    first = np.unique(labels, return_index=True)[1]
    block = share(spark, (np.arange(len(first)), vectors[first]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = TopK(*block.value, k, metric, digits)
        for batch in batches:
            if batch.num_rows:
                best.add(batch.column(0).to_numpy(), vectors_of(batch.column(1)))
        yield from best.results()

    found = top_k_rows(items.mapInArrow(run, RESULT), k, metric)
    # Equal queries were searched once; the block they come from is small.
    alike = spark.createDataFrame(pa.table({"key": labels, "query_id": ids}))
    return (
        found.withColumnRenamed("query_id", "key")
        .join(F.broadcast(alike), "key")
        .select("query_id", "item_id", "rank", "score")
    )


def with_keys(queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Queries under a key of their own (as query_id), written to the shared folder,
    and the (key, query_id) that leads back."""
    ensure_checkpoints(queries.sparkSession)
    rows = queries.select(
        F.monotonically_increasing_id().alias("key"), F.col("query_id").cast("bigint"), "embedding"
    ).checkpoint()
    return rows.select(F.col("key").alias("query_id"), "embedding"), rows.select("key", "query_id")


def named_again(found: DataFrame, names: DataFrame) -> DataFrame:
    """Results of keyed queries under the ids of the queries."""
    joined = found.withColumnRenamed("query_id", "key").join(names, "key")
    return joined.select("query_id", "item_id", "rank", "score")


def _search_blocks(queries, items, k, metric, digits, blocks) -> DataFrame:
    """One scan of the items for each block of queries; results to the shared folder."""
    spark = queries.sparkSession
    keyed, names = with_keys(queries)
    path = new_work_dir(spark, "nearest")
    for block in range(blocks):
        part = keyed.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
        with released():
            found = _search_queries_block(part, items, k, metric, digits)
            found.write.parquet(f"{path}/block={block}")
    return named_again(spark.read.schema(RESULT).parquet(*(f"{path}/block={b}" for b in range(blocks))), names)
