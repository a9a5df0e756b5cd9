"""Fit a re-weighting of the vector dimensions to the judgements."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import vectors as V
from shelfmark.operators.blocks import vectors_of
from shelfmark.operators.pairs import complete_pairs

_EMIT_ROWS = 50_000


def gram_sums(vector_pairs: DataFrame) -> DataFrame:
    """Sums of products (i, j, value), i <= j, over all complete pairs.

    Column ``d`` of a pair is ``query_vec[d] * item_vec[d]``; the last column is
    the score. Each task adds up its own pairs into one packed row, and these are added
    up in as many groups as there are shuffle partitions before they are taken apart, so
    what is shuffled depends on the dimension and the number of tasks only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            q = vectors_of(batch.column(0)).astype(np.float64)
            p = vectors_of(batch.column(1)).astype(np.float64)
            score = batch.column(2).to_numpy(zero_copy_only=False)
            columns = np.concatenate([q * p, score[:, None]], axis=1)
            part = columns.T @ columns
            sums = part if sums is None else sums + part
        if sums is not None:
            packed = sums[np.triu_indices(len(sums))]
            yield pa.RecordBatch.from_pydict({"size": [len(sums)], "sums": [packed]})

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, size = None, 0
        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.column("sums")[row].values.to_numpy()
                size = batch.column("size")[row].as_py()
                sums = part.copy() if sums is None else sums + part
        if sums is None:
            return
        i, j = np.triu_indices(size)
        for s in range(0, len(i), _EMIT_ROWS):
            part = slice(s, s + _EMIT_ROWS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i[part]), pa.array(j[part]), pa.array(sums[part])], names=["i", "j", "value"]
            )

    usable = complete_pairs(vector_pairs, "query_vec", "item_vec", "score").select(
        "query_vec", "item_vec", F.col("score").cast("double")
    )
    groups = int(usable.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = usable.mapInArrow(run, "size bigint, sums array<double>").repartition(groups)
    partial = packed.mapInArrow(unpack, "i bigint, j bigint, value double")
    return partial.groupBy("i", "j").agg(F.sum("value").alias("value"))


def fit_weights(vector_pairs: DataFrame, *, ridge: float = 1e-3, sweeps: int = 20_000) -> tuple[float, ...]:
    """Non-negative weights w that bring ``sum(w * q * p)`` nearest the scores.

    The sums come from one distributed pass; the driver solves a system whose
    size is the vector dimension, and raises if ``sweeps`` do not suffice.
    """
    rows = gram_sums(vector_pairs).toArrow()
    if rows.num_rows == 0:
        raise ValueError("no complete pair to fit on")
    i, j = rows.column("i").to_numpy(), rows.column("j").to_numpy()
    sums = np.zeros((i.max() + 1, i.max() + 1))
    sums[i, j] = sums[j, i] = rows.column("value").to_numpy()
    gram, target = sums[:-1, :-1], sums[:-1, -1]
    return tuple(float(w) for w in _nonnegative_solution(gram, target, ridge, sweeps))


def _nonnegative_solution(
    gram: np.ndarray, target: np.ndarray, ridge: float, sweeps: int
) -> np.ndarray:
    """Ridge least squares under w >= 0, one coordinate at a time."""
    size = len(gram)
    gram = gram + np.eye(size) * (ridge * np.trace(gram) / size + 1e-12)
    weights = np.zeros(size)
    slope = -target.astype(np.float64)
    for _ in range(sweeps):
        moved = 0.0
        for d in range(size):
            best = max(0.0, weights[d] - slope[d] / gram[d, d])
            step = best - weights[d]
            if step:
                slope += step * gram[:, d]
                weights[d] = best
                moved = max(moved, abs(step))
        if moved <= 1e-10 * max(1.0, weights.max()):
            return weights
    raise RuntimeError(f"the fit did not converge in {sweeps} sweeps")


def apply_metric(vectors: DataFrame, weights: Sequence[float], col: str = "embedding") -> DataFrame:
    """Vectors in the fitted space; no text is encoded again."""
    return vectors.withColumn(col, V.reweight(F.col(col), weights))
