"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import store


#: Links, without repeats, that one task settles: some tens of MB.
SETTLED = 500_000


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components of all the links, by union and find."""
    least: dict[int, int] = {}

    def root(i: int) -> int:
        while (up := least.setdefault(i, i)) != i:
            least[i] = least[up]
            i = up
        return i

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            a, b = sorted((root(u), root(v)))
            least[b] = a
    ids = list(least)
    yield pa.RecordBatch.from_pydict(
        {"id": pa.array(ids, pa.int64()), "component": pa.array(map(root, ids), pa.int64())}
    )


def components(links: DataFrame, settled: int = SETTLED) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b), ids of 64 bits; the component
    is its smallest id.

    In turn, every id hands its larger neighbours, then its smaller ones, to the
    smallest id it knows, until each id is linked to its component alone. Minima are
    combined before they are shuffled, so an id with many links is no burden. A table of
    at most ``settled`` links takes one task instead, with the same result.
    With ``settled`` below 0 none does, and ids may be of any type that can be ordered.
    """
    down = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    down = store(down.distinct(), "links")
    if down.count() <= settled:
        return down.coalesce(1).mapInArrow(_settle, "id bigint, component bigint")
    state = None
    while True:
        both = down.union(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = store(large.where("u <> v").distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
        down = store(small.where("u <> v").distinct(), "links")
        seen = down.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.countDistinct("u")
        ).first()
        # One link for each id, and nothing moved: a star for each component.
        if seen == state and seen[0] == seen[2]:
            break
        state = seen
    ends = down.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ends.union(down.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
