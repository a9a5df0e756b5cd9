"""Sources mixed to target weights by entropy balancing.

Every document gets a rate, the times it is taken: as close as possible to one, in
relative entropy, so that the words taken from each source meet its target and no
rate is above ``MOST``. The convex dual has one multiplier for each source, and the
rate of a document of that source is ``min(MOST, exp(multiplier * size / mean size))``.
The multipliers are found by Newton steps, kept inside brackets, over counts of the
documents of each size: each step is one aggregation, and nothing about documents
reaches the driver.

Rates are rounded to copies by size, from large to small: what rounding leaves owing
is carried to the next smaller size, so that a source misses its target by about its
smallest documents. Documents of equal size are told apart by hash, in blocks of
bounded size.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import store

#: Weights of the sources in turn, and most times a document is taken.
WEIGHTS = (5, 2, 1)
MOST = 3
#: Relative error of a source's expected words at which Newton's steps end.
TOLERANCE = 1e-9
MAX_STEPS = 200
#: Documents of equal source and size in a block, about.
BLOCK = 10_000


def size_of(text: Column) -> Column:
    """Words of a text: runs without white space; a null text has none."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), "")
    return F.size(words).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: queue, source_size, target.

    Sources by code point, null last, weigh ``weights`` in turn and share all words; a
    target stops at ``most`` times its source, and the excess goes to the others by
    weight. ``sizes`` has queue (source with ``=`` before it, or null), n and size.
    """
    # One row per source from here on.
    held = sizes.groupBy("queue").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    order = Window.orderBy(F.col("queue").isNull(), "queue")
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    held = held.withColumn("weight", F.get(F.array(*(F.lit(float(w)) for w in weights)), turn))
    held = held.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    # With the sources that cap first in front, the level is the share left per weight.
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("queue").isNull(), "queue")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum(F.col("source_size").cast("double")).over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    held = held.withColumn("level", left / weight)
    over = F.col("level") * F.col("weight") > F.col("cap")
    place = F.row_number().over(filled)
    held = held.withColumn("place", place)
    # The first source that its share does not fill sets the level for all after it.
    free = F.min(F.when(~over, F.struct("place", "level"))).over(every)["level"]
    return held.select(
        "queue", "source_size", F.least("cap", F.coalesce(free, F.col("level")) * F.col("weight")).alias("target")
    )


def balance(cells: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """The multiplier of each source: queue, target, source_size, mean, multiplier.

    ``cells`` counts documents: queue, size, n. Raises if the steps do not converge.
    """
    counts = cells.groupBy("queue").agg(F.sum("n").alias("documents"))
    state = targets.join(counts, targets["queue"].eqNullSafe(counts["queue"])).select(
        targets["queue"], "target", "source_size",
        F.when(F.col("source_size") == 0, 1.0).otherwise(F.col("source_size") / F.col("documents")).alias("mean"),
    )
    state = store(
        state.withColumns(
            {
                "multiplier": F.lit(0.0), "low": F.lit(float("-inf")), "high": F.lit(float("inf")),
                # All of a source at the most, or nothing to take: no multiplier is needed.
                "done": (F.col("source_size") == 0) | (F.col("target") >= F.col("source_size") * most),
            }
        ),
        "multipliers",
    )
    fixed = ("queue", "target", "source_size", "mean")
    for _ in range(MAX_STEPS):
        if state.where(~F.col("done")).isEmpty():
            return state.select(
                *fixed, F.when(F.col("target") >= F.col("source_size") * most, float("inf"))
                .otherwise(F.round("multiplier", 10)).alias("multiplier")
            )
        joined = cells.withColumnRenamed("queue", "of").join(state, F.col("of").eqNullSafe(F.col("queue")))
        tilt = F.col("size") / F.col("mean")
        rate = _rate(F.col("multiplier"), tilt, most)
        words = F.col("n") * F.col("size") * rate
        sums = joined.groupBy(*fixed, "multiplier", "low", "high", "done").agg(
            F.sum(words).alias("taken"),
            F.sum(F.when(rate < most, words * tilt).otherwise(0.0)).alias("slope"),
        )
        gap = F.col("taken") - F.col("target")
        sums = sums.withColumns(
            {
                "low": F.when(gap < 0, F.col("multiplier")).otherwise(F.col("low")),
                "high": F.when(gap >= 0, F.col("multiplier")).otherwise(F.col("high")),
                "next": F.col("multiplier") - gap / F.when(F.col("slope") > 0, F.col("slope")),
                "near": F.abs(gap) <= TOLERANCE * F.col("target"),
            }
        )
        infinite = F.lit(float("inf"))
        halved = (
            F.when(F.col("low") == -infinite, F.col("high") - 1 - F.abs("high"))
            .when(F.col("high") == infinite, F.col("low") + 1 + F.abs("low"))
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        inside = (F.col("next") > F.col("low")) & (F.col("next") < F.col("high")) & (F.abs(F.col("next") - F.col("multiplier")) <= 4)
        bounded = (F.col("low") > -infinite) & (F.col("high") < infinite)
        stuck = bounded & (F.col("high") - F.col("low") <= 1e-12 * (1 + F.abs("high")))
        done = F.col("done") | F.col("near") | stuck
        step = F.when(done, F.col("multiplier")).when(inside, F.col("next")).otherwise(halved)
        state = store(
            sums.select(*fixed, step.alias("multiplier"), "low", "high", done.alias("done")), "multipliers"
        )
    raise RuntimeError(f"entropy balancing did not converge in {MAX_STEPS} steps")


def _rate(multiplier: Column, tilt: Column, most: int) -> Column:
    # Cut before the exponential, which would overflow.
    return F.least(F.lit(float(most)), F.exp(F.least(F.lit(50.0), multiplier * tilt)))


def _rounded(frame: pd.DataFrame, most: int) -> pd.DataFrame:
    """Copies of one source's documents by size: all have ``whole``, ``extra`` of them
    one more. What rounding leaves owing is carried to the next smaller size."""
    frame = frame.sort_values("size", ascending=False)
    whole = np.floor(frame["rate"].to_numpy())
    extra, carried = [], 0.0
    for size, n, rate, least in zip(frame["size"], frame["n"], frame["rate"], whole):
        owing = carried + (rate - least) * size * n
        added = 0
        if size and least < most:
            added = min(n, max(0, int(np.floor(owing / size + 0.5))))
        carried = owing - added * size
        extra.append(added)
    return frame[["queue", "size", "n", "source_size", "target"]].assign(whole=whole, extra=extra)


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Each row of ``docs`` as the struct ``row``, with size, source_size, target, copies.

    Equal rows are interchangeable: which of them is taken more often is not said.
    A source without words has target 0; its documents are taken once and count
    nothing. No documents give no rows. Other columns are carried, whatever their names.
    """
    return _mixed(docs, F.struct(*docs.columns), weights, most)


def _mixed(docs: DataFrame, carried: Column, weights: Sequence[float], most: int) -> DataFrame:
    queue = F.concat(F.lit("="), F.col("source"))
    by_row = ("_queue", "_size", "_mark", "_doc_id")
    rows = docs.select(
        carried.alias("row"), queue.alias("_queue"), size_of(F.col("text")).alias("_size"),
        F.xxhash64("doc_id", "text").alias("_mark"), F.col("doc_id").alias("_doc_id"),
    )
    sizes = store(rows.select(*by_row), "sizes")
    cells = sizes.groupBy(F.col("_queue").alias("queue"), F.col("_size").alias("size")).agg(
        F.count(F.lit(1)).alias("n")
    )
    cells = store(cells, "cells")
    solved = balance(cells, source_targets(cells, weights, most), most)
    solved = solved.withColumnRenamed("queue", "of")
    cells = cells.join(solved, F.col("of").eqNullSafe(F.col("queue")))
    rate = F.when(F.col("size") == 0, 1.0).otherwise(
        F.when(F.col("multiplier") == float("inf"), float(most)).otherwise(
            _rate(F.col("multiplier"), F.col("size") / F.col("mean"), most)
        )
    )
    cells = cells.withColumn("rate", F.round(rate, 9))
    # One row for each size of a source: as many as sizes, however many documents.
    cells = cells.groupBy("queue").applyInPandas(
        lambda frame: _rounded(frame, most),
        "queue string, size bigint, n bigint, source_size bigint, target double, whole bigint, extra bigint",
    )
    cells = store(cells, "rates")
    largest = cells.agg(F.max("n")).first()[0] or 1
    blocks = -(-largest // BLOCK)
    block = F.pmod("_mark", F.lit(blocks)).alias("_block")
    counted = sizes.select("*", block).groupBy("_queue", "_size", "_block").agg(F.count(F.lit(1)).alias("_n"))
    # At most ``blocks`` rows for each source and size.
    ahead = Window.partitionBy("_queue", "_size").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
    plan = counted.join(
        cells, counted["_queue"].eqNullSafe(cells["queue"]) & (counted["_size"] == cells["size"])
    ).select(
        *(counted[c].alias(f"p{c}") for c in ("_queue", "_size", "_block")),
        "_ahead", "extra", "whole", "source_size", "target",
    )
    dealt = rows.withColumn("_block", block)
    dealt = dealt.join(
        plan, dealt["_queue"].eqNullSafe(plan["p_queue"]) & (dealt["_size"] == plan["p_size"])
        & (dealt["_block"] == plan["p_block"]),
    )
    rank = F.row_number().over(Window.partitionBy("_queue", "_size", "_block").orderBy("_mark", "_doc_id"))
    copies = F.col("whole") + F.when(F.col("_ahead") + rank <= F.col("extra"), 1).otherwise(0)
    return dealt.select(
        "row", F.col("_size").alias("size"), F.col("source_size").cast("bigint").alias("source_size"),
        "target", copies.cast("bigint").alias("copies"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as many times as it is taken, columns unchanged."""
    copies = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return mix(docs).where("copies > 0").select("row", copies.alias("copy")).select("row.*")


def op5_mixing(spark, docs: DataFrame) -> DataFrame:
    # The texts are measured where they are read and carried no further.
    mixed = _mixed(docs, F.struct("doc_id"), WEIGHTS, MOST)
    return mixed.select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )
