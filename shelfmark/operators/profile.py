"""Counts that describe a catalog and check an index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def class_histogram(
    queries: DataFrame, class_col: str = "query_class", query_col: str = "query"
) -> DataFrame:
    """Queries per class, most first. A null query is not counted; a null class is
    a class."""
    return (
        queries.groupBy(class_col)
        .agg(F.count(query_col).alias("number_of_queries"))
        .orderBy(F.desc("number_of_queries"), class_col)
    )


def label_histogram(labels: DataFrame, score_col: str = "label_score") -> DataFrame:
    """Labels per score, most first."""
    return (
        labels.groupBy(score_col)
        .agg(F.count(F.lit(1)).alias("number_of_labels"))
        .orderBy(F.desc("number_of_labels"), score_col)
    )


def index_quality(index: DataFrame, source: DataFrame) -> DataFrame:
    """One row that says whether the index holds the source, once and usable."""
    vector = F.col("embedding")
    usable = vector.isNotNull()
    zero = usable & F.forall(vector, lambda x: x == 0)
    broken = usable & F.exists(vector, lambda x: x.isNull() | F.isnan(x))
    counted = index.agg(
        F.count(F.lit(1)).alias("items"),
        F.count_distinct("item_id").alias("distinct_ids"),
        F.count_if(~usable).alias("null_vectors"),
        F.count_if(zero).alias("zero_vectors"),
        F.count_if(broken).alias("broken_vectors"),
        F.min(F.size("embedding")).cast("bigint").alias("min_dim"),
        F.max(F.size("embedding")).cast("bigint").alias("max_dim"),
    )
    rows = source.agg(F.count(F.lit(1)))
    return counted.withColumn("source_items", rows.scalar()).withColumn(
        "ok",
        (F.col("items") == F.col("source_items"))
        & (F.col("items") == F.col("distinct_ids"))
        & (F.col("null_vectors") + F.col("zero_vectors") + F.col("broken_vectors") == 0)
        & (F.coalesce(F.col("min_dim") == F.col("max_dim"), F.lit(True))),
    )
