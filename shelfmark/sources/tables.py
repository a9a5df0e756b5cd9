"""Tables on shared storage, with or without a catalog entry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def save_bronze(df: DataFrame, path: str) -> None:
    """Replace the table in ``path``, schema included."""
    df.write.mode("overwrite").parquet(path)


def load_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace the catalog table ``name``; may be run again."""
    writer = df.write.mode("overwrite").option("overwriteSchema", "true")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def load_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def describe(spark: SparkSession, name: str) -> DataFrame:
    """Column names, types and storage of a catalog table."""
    return spark.sql(f"DESCRIBE EXTENDED {name}")


def add_column_if_missing(df: DataFrame, name: str, kind: str) -> DataFrame:
    """``df`` with a null column of that type, unless it already has one."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def peek(df: DataFrame, n: int = 20) -> DataFrame:
    """``n`` rows to look at."""
    return df.limit(n)
