"""Fit a low-rank map of the vector space on the cosine loss.

The map A takes a vector of ``dim`` numbers to ``rank``. It is fitted to bring
``cos(Aq, Ap)`` near the score of a judged pair, the loss by which sentence encoders are
tuned, in one pass or more over the shuffled batches of
:func:`shelfmark.operators.training.shuffled_batches`.

A step takes many neighbouring batches at once. Its gradient is a sum over pairs: each
task adds up its own pairs, these sums are added up in groups, and the driver gets one
number for each cell of A. The pairs are written once, a folder for each step, so a step
reads its own pairs alone. The number of steps is fixed, so they grow with the pairs and
their number does not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.blocks import vectors_of
from shelfmark.operators.encode import _list_column
from shelfmark.operators.pairs import complete_pairs
from shelfmark.operators.training import order_key, shuffled_batches
from shelfmark.session import new_work_dir, released, share

_EMIT_ROWS = 50_000


@dataclass(frozen=True)
class Training:
    """How a map is fitted. ``warm_up`` steps raise the rate to its value."""

    steps: int = 32
    epochs: int = 2
    rate: float = 0.05
    warm_up: int = 8
    seed: int = 42


def _summed(pairs: DataFrame, work: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
    """Sum over all pairs of what ``work`` makes of a batch: a flat array, as long in
    every task. None without pairs."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            if batch.num_rows:
                q, p = (vectors_of(batch.column(c)).astype(np.float64) for c in ("query_vec", "item_vec"))
                part = work(q, p, batch.column("score").to_numpy(zero_copy_only=False))
                sums = part if sums is None else sums + part
        if sums is not None:
            yield pa.RecordBatch.from_pydict({"sums": [sums]})

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            for row in batch.column("sums"):
                part = row.values.to_numpy()
                sums = part.copy() if sums is None else sums + part
        for first in range(0, 0 if sums is None else len(sums), _EMIT_ROWS):
            part = sums[first : first + _EMIT_ROWS]
            yield pa.RecordBatch.from_pydict({"cell": np.arange(first, first + len(part)), "value": part})

    groups = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = pairs.select("query_vec", "item_vec", F.col("score").cast("double").alias("score"))
    packed = packed.mapInArrow(own, "sums array<double>").repartition(groups)
    cells = packed.mapInArrow(grouped, "cell bigint, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    table = cells.toArrow()
    if table.num_rows == 0:
        return None
    out = np.zeros(table.num_rows)
    out[table.column("cell").to_numpy()] = table.column("value").to_numpy()
    return out


def usable_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs with a score and two vectors that have a direction."""
    kept = complete_pairs(pairs, "query_vec", "item_vec", "score")
    for col in ("query_vec", "item_vec"):
        kept = kept.where(F.exists(col, lambda x: x != 0))
    return kept


def gradient(pairs: DataFrame, matrix: np.ndarray) -> tuple[np.ndarray, float, int]:
    """Mean gradient of the squared gap between cosine and score at ``matrix``, the mean
    loss and the number of pairs; ``pairs`` are usable ones."""
    block = share(pairs.sparkSession, matrix)

    def work(q: np.ndarray, p: np.ndarray, score: np.ndarray) -> np.ndarray:
        a, b = q @ block.value.T, p @ block.value.T
        long_a, long_b = (np.sqrt(np.einsum("nr,nr->n", x, x)) for x in (a, b))
        # A map may send a vector to nothing: no direction, no slope.
        long_a[long_a == 0] = np.inf
        long_b[long_b == 0] = np.inf
        cosine = np.einsum("nr,nr->n", a, b) / (long_a * long_b)
        gap = cosine - score
        to_a = b / (long_a * long_b)[:, None] - a * (cosine / long_a**2)[:, None]
        to_b = a / (long_a * long_b)[:, None] - b * (cosine / long_b**2)[:, None]
        slope = (2 * gap[:, None] * to_a).T @ q + (2 * gap[:, None] * to_b).T @ p
        return np.concatenate([slope.ravel(), [np.dot(gap, gap), len(gap)]])

    with released():
        sums = _summed(pairs, work)
    if sums is None:
        return np.zeros_like(matrix), 0.0, 0
    n = sums[-1]
    return sums[:-2].reshape(matrix.shape) / n, float(sums[-2] / n), int(n)


def principal_map(pairs: DataFrame, rank: int) -> np.ndarray:
    """The ``rank`` directions in which the vectors of usable pairs reach farthest: the
    map that keeps cosines best before anything is fitted."""
    sums = _summed(pairs, lambda q, p, score: (q.T @ q + p.T @ p).ravel())
    if sums is None:
        raise ValueError("no complete pair to fit on")
    dim = int(len(sums) ** 0.5)
    _, directions = np.linalg.eigh(sums.reshape(dim, dim))
    found = directions[:, ::-1][:, :rank].T
    # A direction and its opposite are as good: take the one whose largest part is positive.
    signs = np.sign(found[np.arange(len(found)), np.abs(found).argmax(axis=1)])
    return found * signs[:, None]


def _steps(ids: DataFrame, training: Training) -> tuple[Column, int]:
    """The step that a pair's batch belongs to, as a column of its ``_key`` and ``id``, and the
    number of batches.

    Batches follow the shuffled order, so a step is a range of it: the driver gets the
    first row of each step, and no pair is joined with its place.
    """
    ordered = shuffled_batches(ids, "id", seed=training.seed).select("id", "position", "batch_id")
    path = new_work_dir(ids.sparkSession, "order")
    ordered.write.parquet(path)
    ordered = ids.sparkSession.read.schema(ordered.schema).parquet(path)
    batches = (ordered.agg(F.max("batch_id")).first()[0] or 0) + 1
    step = F.floor(F.col("batch_id") * training.steps / F.lit(batches)).cast("int")
    place = F.struct("_key", "id")
    keyed = ordered.select("id", step.alias("step"), order_key("id", training.seed).alias("_key"))
    # At most one row for each step.
    first = keyed.groupBy("step").agg(F.min(place).alias("first")).orderBy("step").collect()
    found = F.lit(first[0]["step"] if first else 0)
    for row in first[1:]:
        start = F.struct(F.lit(row["first"][0]), F.lit(row["first"][1]).cast(ids.schema["id"].dataType))
        found = F.when(place >= start, F.lit(row["step"])).otherwise(found)
    return found, batches


def fit_projection(pairs: DataFrame, rank: int, training: Training = Training()) -> np.ndarray:
    """The map (rank, dim) fitted to ``pairs`` (id, query_vec, item_vec, score).

    ``id`` names each pair once; the order of the pairs follows from it and the seed.
    """
    pairs = usable_pairs(pairs)
    spark = pairs.sparkSession
    step, batches = _steps(pairs.select("id"), training)
    path = new_work_dir(spark, "steps")
    # Pairs get their step where they lie; a folder takes a file from each task.
    keyed = pairs.select("id", "query_vec", "item_vec", "score", order_key("id", training.seed).alias("_key"))
    keyed.select("query_vec", "item_vec", "score", step.alias("step")).write.partitionBy("step").parquet(path)
    stored = spark.read.parquet(path)
    matrix = principal_map(stored, rank)
    first, second = np.zeros_like(matrix), np.zeros_like(matrix)
    taken = 0
    for _ in range(training.epochs):
        for number in range(min(training.steps, batches)):
            slope, _, n = gradient(stored.where(F.col("step") == number), matrix)
            if not n:
                continue
            taken += 1
            first += 0.1 * (slope - first)
            second += 0.001 * (slope**2 - second)
            rate = training.rate * min(1.0, taken / max(training.warm_up, 1))
            first_whole, second_whole = first / (1 - 0.9**taken), second / (1 - 0.999**taken)
            matrix = matrix - rate * first_whole / (np.sqrt(second_whole) + 1e-8) / np.sqrt(matrix.size)
    return matrix


def apply_projection(vectors: DataFrame, matrix: np.ndarray, *cols: str) -> DataFrame:
    """``vectors`` with the named columns (``embedding`` by default) mapped and scaled to
    length one. Null stays null; what is mapped to nothing stays the zero vector."""
    cols = cols or ("embedding",)
    block = share(vectors.sparkSession, np.asarray(matrix, np.float64))
    names = vectors.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = []
            for name, column in zip(names, batch.columns):
                if name in cols and batch.num_rows:
                    valid = column.is_valid()
                    column = _list_column(projected(vectors_of(column.drop_null()), block.value), valid, len(block.value))
                columns.append(column)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return vectors.mapInArrow(run, vectors.schema)


def projected(vectors: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Rows mapped and scaled to length one, as 32-bit floats."""
    if not len(vectors):
        return np.zeros((0, len(matrix)), np.float32)
    mapped = vectors.astype(np.float64) @ np.asarray(matrix).T
    lengths = np.sqrt(np.einsum("nr,nr->n", mapped, mapped))
    lengths[lengths == 0] = 1
    return (mapped / lengths[:, None]).astype(np.float32)
