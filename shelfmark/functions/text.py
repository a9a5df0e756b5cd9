"""Columns derived from catalog text and relevance labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The weight of each judgement, by lower-cased label.
LABEL_SCORES = {"exact": 1.0, "partial": 0.75, "irrelevant": 0.0}


def search_text(description: str | Column, name: str | Column) -> Column:
    """The description, or the name where there is no description. An empty
    description is kept."""
    as_col = [F.col(c) if isinstance(c, str) else c for c in (description, name)]
    return F.coalesce(*as_col)


def searchable(
    products: DataFrame,
    *,
    item_id: str = "product_id",
    name: str = "product_name",
    description: str = "product_description",
) -> DataFrame:
    """(item_id, item_name, item_text) of every product; the text may be null."""
    return products.select(
        F.col(item_id).cast("bigint").alias("item_id"),
        F.col(name).alias("item_name"),
        search_text(description, name).alias("item_text"),
    )


def split_by_text(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items that can be encoded, and those set aside for want of any text."""
    has_text = F.col("item_text").isNotNull()
    return items.where(has_text), items.where(~has_text)


def to_documents(df: DataFrame, text_col: str) -> DataFrame:
    """(page_content, metadata): the text, and all other columns as a struct."""
    rest = [c for c in df.columns if c != text_col]
    return df.select(F.col(text_col).alias("page_content"), F.struct(*rest).alias("metadata"))


def label_score(label: str | Column, scores: Mapping[str, float] = LABEL_SCORES) -> Column:
    """The weight of a label, ignoring case; NULL for a label without one."""
    word = F.lower(F.col(label) if isinstance(label, str) else label)
    value = F.lit(None).cast(T.FloatType())
    for name, score in reversed(list(scores.items())):
        value = F.when(word == name, F.lit(float(score)).cast("float")).otherwise(value)
    return value


def score_labels(
    labels: DataFrame,
    label_col: str = "label",
    scores: Mapping[str, float] = LABEL_SCORES,
    out: str = "label_score",
) -> DataFrame:
    """``labels`` with the score column added, or recomputed where it exists."""
    return labels.withColumn(out, label_score(label_col, scores))
