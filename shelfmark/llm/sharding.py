"""Documents dealt to shards by longest processing time first.

Documents with equal texts form a group and stay together. Groups sorted by size go
to the least loaded shard, which a heap gives. The heap runs on the driver over a
number of items that does not grow with the data: groups that hold more than one
part in ``PARTS`` of a shard go one by one (there are at most ``shards * PARTS`` of
them) and all smaller groups are bundled by hash into ``shards * PARTS`` items.
A bundle is about one part in ``PARTS`` of a shard, and so is the imbalance.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import key128, running_totals, store

#: Items a shard is filled from, about.
PARTS = 1024


def least_loaded(sizes: list[int], shards: int) -> list[int]:
    """The shard of each item; largest items first, ties by place in the list."""
    heap = [(0, shard) for shard in range(shards)]
    placed = [0] * len(sizes)
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        load, shard = heapq.heappop(heap)
        placed[item] = shard
        heapq.heappush(heap, (load + sizes[item], shard))
    return placed


def shard_documents(docs: DataFrame, shards: int = 24, parts: int = PARTS) -> DataFrame:
    """Each document with its size, text_crc32, shard and slot.

    A null text is as an empty one: size 8 and the crc of no bytes. Slots number the
    documents of a shard from 0 by (doc_id, text hash), nulls first; documents equal
    in both are interchangeable.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(8)).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        *key128(text),
    )
    rows = store(rows, "sizes").withColumn("bundle", F.pmod("key_a", F.lit(shards * parts)))
    groups = store(rows.groupBy("key_a", "key_b", "bundle").agg(F.sum("size").alias("held")), "groups")
    total = groups.agg(F.coalesce(F.sum("held"), F.lit(0)).alias("n")).first()["n"]
    alone = F.col("held") * F.lit(shards * parts) > F.lit(total)
    # Both lists have at most shards * parts rows.
    large = groups.where(alone).select("key_a", "key_b", "held").collect()
    small = groups.where(~alone).groupBy("bundle").agg(F.sum("held").alias("held")).collect()
    large.sort(key=lambda r: (r["key_a"], r["key_b"]))
    small.sort(key=lambda r: r["bundle"])
    placed = least_loaded([r["held"] for r in (*large, *small)], shards)
    by_group = spark.createDataFrame(
        [(r["key_a"], r["key_b"], s) for r, s in zip(large, placed)], "key_a bigint, key_b bigint, own int"
    )
    by_bundle = spark.createDataFrame(
        [(r["bundle"], s) for r, s in zip(small, placed[len(large) :])], "bundle bigint, shared int"
    )
    dealt = rows.join(F.broadcast(by_group), ["key_a", "key_b"], "left").join(
        F.broadcast(by_bundle), "bundle", "left"
    )
    dealt = dealt.select(
        "doc_id", "size", "text_crc32", F.coalesce("own", "shared").alias("shard"), "key_a", "key_b"
    )
    return running_totals(dealt, {"slot": F.lit(1)}, ["doc_id", "key_a", "key_b"], "shard").drop(
        "key_a", "key_b"
    )


def op10_sharding(spark, docs: DataFrame) -> DataFrame:
    return shard_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
