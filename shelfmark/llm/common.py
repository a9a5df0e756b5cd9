"""What several operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.session import new_work_dir, ship

#: Columns of ``documents``, in order.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")

#: Most bytes of text that a Python task works on at once, one long text aside.
SLICE_BYTES = 1 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, fixes row keys."""
    spark = df.sparkSession
    path = new_work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def key128(*columns: Column | str) -> list[Column]:
    """Two independent 64-bit hashes that together stand for the columns' value."""
    return [
        F.xxhash64(F.lit(1), *columns).alias("key_a"),
        F.xxhash64(F.lit(2), *columns).alias("key_b"),
    ]


def running_totals(
    df: DataFrame, totals: dict[str, str | Column], order: Sequence[str], group: str | None = None
) -> DataFrame:
    """For each row, what the rows before it add up to, in its group.

    ``totals`` maps new columns to what they add up. Rows are dealt by ranges of
    the order, added up inside each range, and shifted by the ranges before: no
    task holds a group. ``group`` must not be null.
    """
    by = [group] if group else []
    ranged = df.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id())
    ranged = store(
        ranged.select("*", *(F.expr(c).alias(f"_{n}") if isinstance(c, str) else c.alias(f"_{n}")
                             for n, c in totals.items())),
        "ranges",
    )
    within = Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = Window.partitionBy(*by) if by else Window.partitionBy()
    before = before.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range (and group in it).
    bases = ranged.groupBy(*by, "_range").agg(*(F.sum(f"_{n}").alias(f"_{n}") for n in totals))
    bases = bases.select(
        *by, "_range", *(F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_base_{n}") for n in totals)
    )
    summed = ranged.select(
        *df.columns, "_range",
        *(F.coalesce(F.sum(f"_{n}").over(within), F.lit(0)).alias(n) for n in totals),
    )
    joined = summed.join(bases, [*by, "_range"])
    return joined.select(*df.columns, *((F.col(n) + F.col(f"_base_{n}")).alias(n) for n in totals))


def text_slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about SLICE_BYTES of text, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        first, held = 0, 0
        for row, size in enumerate(sizes):
            if row > first and held + size > SLICE_BYTES:
                yield batch.slice(first, row - first)
                first, held = row, 0
            held += size
        if first < batch.num_rows:
            yield batch.slice(first)
