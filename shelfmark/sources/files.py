"""Typed readers for the three tab-separated input files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Column names, types and order of the input files.
PRODUCTS = (
    "product_id int, product_name string, product_class string, "
    "category_hierarchy string, product_description string, product_features string, "
    "rating_count float, average_rating float, review_count float"
)
QUERIES = "query_id int, query string, query_class string"
LABELS = "id int, query_id int, product_id int, label string"


def read_tsv(spark: SparkSession, path: str, schema: str, *, multi_line: bool) -> DataFrame:
    """Tab-separated rows under a header, by a declared schema.

    ``multi_line`` lets a quoted field hold line breaks. Such a file cannot be
    split, so a large table should then come as many files.
    """
    return spark.read.csv(
        path, schema=schema, sep="\t", header=True, escape='"', multiLine=multi_line
    )


def read_products(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    return read_tsv(spark, path, PRODUCTS, multi_line=multi_line)


def read_queries(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    return read_tsv(spark, path, QUERIES, multi_line=multi_line)


def read_labels(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    return read_tsv(spark, path, LABELS, multi_line=multi_line)


def preview_file(spark: SparkSession, path: str) -> DataFrame:
    """A raw look at a file as comma-separated strings, without a schema."""
    return spark.sql(f"SELECT * FROM csv.`{path}`")
