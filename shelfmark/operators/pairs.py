"""Judged pairs: queries, items and the judgements that link them."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import config
from shelfmark.functions.encoders import Encoder
from shelfmark.operators.blocks import vectors_of
from shelfmark.operators.encode import encode_distinct
from shelfmark.operators.skew import counted_bytes, join_counted


def judged_pairs(
    items: DataFrame, labels: DataFrame, queries: DataFrame, *keep: str
) -> DataFrame:
    """(keep..., query_id, item_id, query, item_text, score), one row per label.

    ``items`` is (item_id, item_text, ...), ``labels`` is (query_id, product_id,
    label_score, ...), ``queries`` is (query_id, query, ...). ``keep`` names label
    columns to carry along, such as the label's own id. Labels of unknown items or
    queries drop out; repeated labels and null scores stay.
    """
    judged = labels.select(
        *keep,
        "query_id",
        F.col("product_id").alias("item_id"),
        F.col("label_score").alias("score"),
    )
    queries, items = queries.select("query_id", "query"), items.select("item_id", "item_text")
    # Queries are short, so the long item text is attached last.
    asked = join_counted(judged, queries, "query_id", counted_bytes(queries))
    linked = join_counted(asked, items, "item_id", counted_bytes(items), keys=judged)
    return linked.select(*keep, "query_id", "item_id", "query", "item_text", "score")


def complete_pairs(pairs: DataFrame, *cols: str) -> DataFrame:
    """Pairs in which none of ``cols`` is null."""
    return pairs.dropna(subset=list(cols))


def incomplete_count(pairs: DataFrame, *cols: str) -> DataFrame:
    """One row: ``pairs`` and how many of them are ``incomplete``."""
    missing = F.lit(False)
    for col in cols:
        missing = missing | F.col(col).isNull()
    return pairs.agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if(missing).alias("incomplete")
    )


def join_vectors(
    judged: DataFrame,
    query_vectors: DataFrame,
    item_vectors: DataFrame,
    dim: int,
    *,
    query_rows: int | None = None,
    item_rows: int | None = None,
    broadcast_bytes: int = config.BROADCAST_BYTES,
) -> DataFrame:
    """Put both vectors on each judged row, by key.

    ``judged`` has query_id and item_id; the vector frames are (query_id,
    embedding) and (item_id, embedding). The result adds ``query_vec`` and
    ``item_vec``. The numbers of vectors are counted unless given.
    """
    linked = judged
    for key, vectors, rows in (
        ("item_id", item_vectors, item_rows),
        ("query_id", query_vectors, query_rows),
    ):
        named = vectors.select(key, F.col("embedding").alias(key.replace("_id", "_vec")))
        size = (vectors.count() if rows is None else rows) * (4 * dim + 32)
        linked = join_counted(linked, named, key, size, keys=judged, budget=broadcast_bytes)
    return linked


def encode_pairs(
    judged: DataFrame, queries: DataFrame, items: DataFrame, encoder: Encoder
) -> DataFrame:
    """Judged rows with both vectors, each query and item encoded once.

    ``judged`` needs query_id and item_id only; keep it narrow, it is read for
    the ids and for the join.
    """
    counted = judged.agg(F.count_distinct("query_id"), F.count_distinct("item_id")).first()
    query_rows, item_rows = counted
    return join_vectors(
        judged,
        encode_distinct(queries, judged, "query_id", "query", encoder, id_rows=query_rows),
        encode_distinct(items, judged, "item_id", "item_text", encoder, id_rows=item_rows),
        encoder.dim,
        query_rows=query_rows,
        item_rows=item_rows,
    )


def pair_cosine(
    pairs: DataFrame, models: Mapping[str, Sequence[float] | None] | None = None
) -> DataFrame:
    """``pairs`` with the ``cosine`` of query_vec and item_vec in their place.

    The value lies in [-1, 1] and is null when a vector is missing or has no
    length. With ``models`` there is one row per pair and ``model``, the
    dimensions weighted as the model says.
    """
    kept = [f for f in pairs.schema.fields if f.name not in ("query_vec", "item_vec")]
    names = [f.name for f in kept]
    added = [T.StructField("model", T.StringType())] if models else []
    schema = T.StructType([*kept, *added, T.StructField("cosine", T.DoubleType())])
    weights = {
        name: None if w is None else np.asarray(w, dtype=np.float64)
        for name, w in (models or {"": None}).items()
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("query_vec"), batch.column("item_vec")
            both = pc.and_(left.is_valid(), right.is_valid())
            q, p = vectors_of(left.filter(both)), vectors_of(right.filter(both))
            present = both.to_numpy(zero_copy_only=False)
            rest = [batch.column(n) for n in names]
            for name, w in weights.items():
                value = np.full(batch.num_rows, np.nan)
                value[present] = _cosines(q, p, w)
                model = [pa.array([name] * batch.num_rows)] if added else []
                yield pa.RecordBatch.from_arrays(
                    [*rest, *model, pa.array(value, from_pandas=True)], names=schema.names
                )

    return pairs.mapInArrow(run, schema)


def _cosines(a: np.ndarray, b: np.ndarray, weights: np.ndarray | None) -> np.ndarray:
    if a.shape != b.shape:
        raise ValueError(f"vectors of {a.shape[1]} and {b.shape[1]} dimensions cannot be paired")
    a, b = a.astype(np.float64), b.astype(np.float64)
    weighted = a if weights is None else a * weights
    b_weighted = b if weights is None else b * weights
    lengths = np.sqrt(
        np.einsum("nd,nd->n", weighted, a) * np.einsum("nd,nd->n", b_weighted, b)
    )
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(lengths > 0, np.einsum("nd,nd->n", weighted, b) / lengths, np.nan)


def is_held_out(query_id: str = "query_id", share: float = 0.2, seed: int = 42):
    """Whether a row belongs to the held-out part; all rows of a query go together."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(query_id).cast("bigint").cast("string")))
    spot = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(1_000_000))
    return spot < int(share * 1_000_000)
