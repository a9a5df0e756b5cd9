"""How well cosine similarity agrees with the judgements."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.pairs import complete_pairs, pair_cosine


def correlation(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation; NULL, not an error, when a side is constant."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def agreement(pairs: DataFrame, *by: str) -> DataFrame:
    """Mean cosine and its correlation with the score, over complete pairs.

    One row, or one per value of ``by``: (pairs, mean_cosine, correlation).
    """
    return (
        complete_pairs(pairs, "cosine", "score")
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("pairs"),
            F.avg("cosine").alias("mean_cosine"),
            correlation("cosine", F.col("score").cast("double")).alias("correlation"),
        )
    )


def compare_models(
    vector_pairs: DataFrame, models: Mapping[str, Sequence[float] | None], *by: str
) -> DataFrame:
    """:func:`agreement` per model, all models scored in one pass.

    A model is named weights of the dimensions, or None for the vectors as they
    are.
    """
    return agreement(pair_cosine(vector_pairs, models), "model", *by)


def side_by_side(comparison: DataFrame, before: str, after: str) -> DataFrame:
    """One row: mean cosine and correlation before and after."""

    def of(model: str, col: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col(col)))

    return comparison.agg(
        of(before, "mean_cosine").alias("mean_cosine_before"),
        of(after, "mean_cosine").alias("mean_cosine_after"),
        of(before, "correlation").alias("correlation_before"),
        of(after, "correlation").alias("correlation_after"),
    )
