"""Equi-joins that stay balanced when a few keys hold much of the data."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import config


#: Room for the plain columns of a row in a broadcast table.
_ROW_BYTES = 64


def find_hot_keys(
    many: DataFrame, on: str, *, min_rows: int = config.HOT_ROWS
) -> list[tuple[object, int]]:
    """Keys too large for one task, each with the number of parts to cut it into.

    A key is hot when it holds more rows than two average shuffle partitions (and
    than ``min_rows``), so there are always fewer hot keys than partitions. Rows
    are counted per task before the counts are shuffled.
    """
    total = many.count()
    if total <= min_rows:
        return []
    partitions = int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    average = total / partitions
    found = (
        many.where(F.col(on).isNotNull())
        .groupBy(on)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > max(min_rows, int(2 * average)))
    )
    return [(row[on], math.ceil(row["rows"] / average)) for row in found.collect()]


def counted_bytes(df: DataFrame, *, budget: int = config.BROADCAST_BYTES) -> int:
    """Size of a frame of plain columns: rows, and the lengths of its strings.

    Strings are only measured while the number of rows alone would fit.
    """
    size = df.count() * _ROW_BYTES
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if size <= budget and strings:
        lengths = [F.coalesce(F.sum(F.octet_length(c).cast("bigint")), F.lit(0)) for c in strings]
        size += sum(df.agg(*lengths).first())
    return size


def join_counted(
    many: DataFrame,
    few: DataFrame,
    on: str,
    few_bytes: int,
    *,
    keys: DataFrame | None = None,
    budget: int = config.BROADCAST_BYTES,
) -> DataFrame:
    """Inner join to a side whose size the caller has counted: broadcast if it fits,
    otherwise shuffled with hot keys split.

    ``keys`` is a cheaper frame to look for hot keys in, such as ``many`` before
    earlier joins. Spark takes an array for a single element when it guesses
    sizes, so vectors are never left to be broadcast by guess.
    """
    if few_bytes <= budget:
        return many.join(F.broadcast(few), on)
    hot = find_hot_keys(many if keys is None else keys, on)
    return skew_join(many, few, on, hot=hot, shuffled=True)


def skew_join(
    many: DataFrame,
    few: DataFrame,
    on: str,
    *,
    hot: list[tuple[object, int]] | None = None,
    shuffled: bool = False,
) -> DataFrame:
    """Inner join of a large side that may have hot keys to one row set per key.

    Without hot keys this is a plain join. Otherwise the rows of a hot key are
    dealt over its parts and the matching rows of ``few`` are copied to each
    part. Rows with a null key match nothing and are left out first. ``shuffled``
    rules out that Spark broadcasts ``few`` after all.
    """
    many = many.where(F.col(on).isNotNull())
    if hot is None:
        hot = find_hot_keys(many, on)
    if not hot:
        return many.join(few.hint("merge") if shuffled else few, on)
    schema = T.StructType([many.schema[on], T.StructField("_parts", T.IntegerType())])
    # Fewer rows than there are shuffle partitions.
    cut = F.broadcast(many.sparkSession.createDataFrame(hot, schema))
    # The partition id spreads rows that are equal in every column, and stays the
    # same when a lost task is run again.
    plain = [f.name for f in many.schema.fields if isinstance(f.dataType, T.AtomicType)]
    spot = F.xxhash64(F.spark_partition_id(), *plain)
    part = F.coalesce(F.pmod(spot, F.col("_parts").cast("bigint")).cast("int"), F.lit(0))
    dealt = many.join(cut, on, "left").withColumn("_part", part).drop("_parts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    copied = few.join(cut, on, "left").withColumn("_part", copies).drop("_parts")
    if shuffled:
        copied = copied.hint("merge")
    return dealt.join(copied, [on, "_part"]).drop("_part")
