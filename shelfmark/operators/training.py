"""Training examples and their reproducible order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import new_work_dir

#: Hex digits of the order key that name a slot: 65,536 slots.
SLOT_DIGITS = 4


def training_examples(pairs: DataFrame, *keep: str) -> DataFrame:
    """(keep..., texts, label) of every pair with both texts and a score."""
    return pairs.dropna(subset=["query", "item_text", "score"]).select(
        *keep,
        F.array("query", "item_text").alias("texts"),
        F.col("score").cast("float").alias("label"),
    )


def order_key(id_col: str, seed: int) -> Column:
    """What examples are shuffled by; the id parts those that share it."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))


def shuffled_batches(
    examples: DataFrame, id_col: str, *, seed: int = 42, batch_size: int = 16
) -> DataFrame:
    """Examples with ``position`` (from 1) and ``batch_id`` in a shuffled order.

    The order is that of an md5 of seed and id, so it does not depend on how the
    data is partitioned. ``id_col`` names each example once, like a label's id: a
    product or query id may repeat without bound and would crowd one slot.
    Positions are counted per slot of equal key prefixes and shifted by the size
    of the slots before; only the slot sizes, a fixed number of rows, are ever in
    one place. The examples are written to the shared folder first, so that counting
    them does not make them twice.
    """
    path = new_work_dir(examples.sparkSession, "examples")
    examples.write.parquet(path)
    examples = examples.sparkSession.read.schema(examples.schema).parquet(path)
    keyed = examples.withColumn("_key", order_key(id_col, seed)).withColumn(
        "_slot", F.substring("_key", 1, SLOT_DIGITS)
    )
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy("_slot")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_slot", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    within = F.row_number().over(Window.partitionBy("_slot").orderBy("_key", id_col))
    return (
        keyed.withColumn("_within", within)
        .join(F.broadcast(offsets), "_slot")
        .withColumn("position", (F.col("_before") + F.col("_within")).cast("bigint"))
        .withColumn("batch_id", F.floor((F.col("position") - 1) / batch_size).cast("bigint"))
        .drop("_key", "_slot", "_within", "_before")
    )
