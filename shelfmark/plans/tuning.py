"""Fit the vector space to the judgements and re-index in it."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.config import Names
from shelfmark.functions.encoders import Encoder, ProjectedEncoder, ReweightedEncoder
from shelfmark.operators.evaluate import agreement, compare_models
from shelfmark.operators.metric import apply_metric, fit_weights
from shelfmark.operators.pairs import encode_pairs, is_held_out, pair_cosine
from shelfmark.operators.projection import Training, apply_projection, fit_projection
from shelfmark.plans.catalog import catalog_documents
from shelfmark.session import ensure_checkpoints
from shelfmark.sources import tables
from shelfmark.sources.index import Index, read_index, write_vectors

BEFORE, AFTER, PROJECTED = "original", "tuned", "projected"


@dataclass(frozen=True)
class Tuned:
    """Fitted weights and the evidence for them."""

    weights: tuple[float, ...]
    comparison: DataFrame
    improved: bool


def tune(vector_pairs: DataFrame, *, share: float = 0.2, seed: int = 42) -> Tuned:
    """Fit weights on the training queries and judge them on the others.

    ``vector_pairs`` is (query_id, item_id, query_vec, item_vec, score, ...); it
    is read several times, so pass a written table when it is costly to make.
    ``comparison`` has the agreement per model on each part. The weights count as
    an improvement if the held-out correlation rose.
    """
    marked = vector_pairs.withColumn("held_out", is_held_out(share=share, seed=seed))
    weights = fit_weights(marked.where(~F.col("held_out")))
    if not any(weights):
        return Tuned(weights, compare_models(marked, {BEFORE: None}, "held_out"), False)
    comparison = compare_models(marked, {BEFORE: None, AFTER: weights}, "held_out")
    # Four rows: one per model and part.
    rows = comparison.collect()
    comparison = vector_pairs.sparkSession.createDataFrame(rows, comparison.schema)
    found = {row["model"]: row["correlation"] for row in rows if row["held_out"]}
    before, after = found.get(BEFORE), found.get(AFTER)
    improved = after is not None and (before is None or after > before)
    return Tuned(weights, comparison, improved)


def reindex(
    index: Index, encoder: Encoder, tuned: Tuned, path: str, *, lists: int | None = None
) -> tuple[int, ReweightedEncoder]:
    """Write the index in the fitted space, from the vectors it already has. Texts stay
    where they are, and the new encoder is stored.

    Returns the new version and the encoder that queries must use with it.
    """
    if not tuned.improved:
        raise ValueError("the fitted weights did not improve held-out agreement; index kept")
    encoder = ReweightedEncoder(encoder, tuned.weights)
    vectors = apply_metric(index.items.select("item_id", "embedding"), tuned.weights)
    version = write_vectors(
        vectors, path, encoder.model_id, encoder.dim, lists=lists, texts_of=index, encoder=encoder
    )
    return version, encoder


def tune_projection(
    vector_pairs: DataFrame, rank: int, *, share: float = 0.2, seed: int = 42, training: Training = Training()
) -> tuple[np.ndarray, DataFrame]:
    """A low-rank map fitted on the training queries, and its agreement beside that of the
    vectors as they are, on both parts: (model, held_out, pairs, mean_cosine, correlation).

    ``vector_pairs`` is (id, query_id, query_vec, item_vec, score, ...), read once a step
    and a few times more, so pass a written table.
    """
    marked = vector_pairs.withColumn("held_out", is_held_out(share=share, seed=seed))
    matrix = fit_projection(marked.where(~F.col("held_out")), rank, training)
    kept = marked.select("held_out", "score", "query_vec", "item_vec")
    moved = apply_projection(kept, matrix, "query_vec", "item_vec")
    both = kept.withColumn("model", F.lit(BEFORE)).unionByName(moved.withColumn("model", F.lit(PROJECTED)))
    return matrix, agreement(pair_cosine(both), "model", "held_out")


def reindex_projected(
    index: Index, encoder: Encoder, matrix: np.ndarray, path: str, *, lists: int | None = None
) -> tuple[int, ProjectedEncoder]:
    """Write the index in the mapped space, from the vectors it already has; the encoder
    of the new version is stored with it."""
    encoder = ProjectedEncoder.of(encoder, matrix)
    vectors = apply_projection(index.items.select("item_id", "embedding"), matrix)
    version = write_vectors(
        vectors, path, encoder.model_id, encoder.dim, lists=lists, texts_of=index, encoder=encoder
    )
    return version, encoder


def judged_vectors(spark: SparkSession, names: Names, encoder: Encoder) -> DataFrame:
    """(query_id, item_id, score, query_vec, item_vec) of the stored labels, written
    to the shared folder so that later passes do not encode again."""
    ensure_checkpoints(spark)
    labels = tables.load_table(spark, names.table(names.labels)).select(
        F.col("query_id").cast("bigint"),
        F.col("product_id").cast("bigint").alias("item_id"),
        F.col("label_score").alias("score"),
    )
    queries = tables.load_table(spark, names.table(names.queries)).select(
        F.col("query_id").cast("bigint"), "query"
    )
    return encode_pairs(labels, queries, catalog_documents(spark, names), encoder).checkpoint()


def tune_catalog(
    spark: SparkSession,
    names: Names,
    encoder: Encoder,
    path: str,
    *,
    share: float = 0.2,
    seed: int = 42,
) -> tuple[Tuned, Index, Encoder]:
    """From stored labels to a tuned index: fit, judge, and write if it helped.

    Returns the evidence, and the index to search with its encoder: the new
    version, or the one there was.
    """
    index = read_index(spark, path, encoder)
    tuned = tune(judged_vectors(spark, names, encoder), share=share, seed=seed)
    if not tuned.improved:
        return tuned, index, encoder
    version, tuned_encoder = reindex(index, encoder, tuned, path)
    return tuned, read_index(spark, path, tuned_encoder, version=version), tuned_encoder
