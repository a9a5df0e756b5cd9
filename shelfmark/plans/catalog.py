"""Load the three input files into tables, with scored labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from shelfmark.config import Names
from shelfmark.functions.text import LABEL_SCORES, score_labels, searchable
from shelfmark.sources import files, tables


def load_catalog(
    spark: SparkSession,
    products_path: str,
    queries_path: str,
    labels_path: str,
    names: Names,
    *,
    scores: Mapping[str, float] = LABEL_SCORES,
) -> None:
    """Create the database and (re)write products, queries and labels.

    Labels get their score in the same write, so no second pass updates them.
    """
    tables.create_database(spark, names.database)
    labels = score_labels(files.read_labels(spark, labels_path), scores=scores)
    for name, df in (
        (names.products, files.read_products(spark, products_path)),
        (names.queries, files.read_queries(spark, queries_path)),
        (names.labels, labels),
    ):
        tables.save_table(df, names.table(name), names.bronze(name))


def catalog_documents(spark: SparkSession, names: Names) -> DataFrame:
    """(item_id, item_name, item_text) of the stored products."""
    return searchable(tables.load_table(spark, names.table(names.products)))
