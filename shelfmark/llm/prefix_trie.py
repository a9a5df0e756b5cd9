"""The trie of conversations by their first turns, with sums over subtrees.

A node is a distinct sequence of first turns. Its key is a hash of its depth and of sums
of hashes of (place, role, text), so keys of all prefixes are running totals and no task
holds a conversation. The root has no turns.

Rollup. ``Weight`` of a node: rows that its members have below it, known from the
grouping; no fewer than the nodes below it, and never more than at its parent. Nodes of
at least ``light`` are heavy. What hangs below them are light subtrees of at most
``light`` nodes; many of them are rolled up together in one task by centroid
decomposition: a component is split at the node whose removal leaves parts of half its
size at most, the total below that node is added along the path from it to the
component's top, and the parts are split in turn. Heavy nodes have at most
(rows / light) leaves. They are cut into one path for each of these leaves; the paths
are a forest again, rolled up by centroid decomposition, and running totals along each
path give its nodes their sums. ``light`` is at least the root of the number of rows, so
neither a light subtree nor the forest of paths is larger than that.

Turns are ordered by turn (null first), ties by role and text, so equal rows are
interchangeable. Null role or text is empty. Rows without conv_id belong to no
conversation and are left out. Repeated rows are turns of their own. Other columns are
not read. A table without conversations has no nodes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import key128, running_totals, store

#: Least weight of a heavy node; more if the table's root is larger.
LIGHT = 50_000
#: Conversations that take their first turns from one of them, and one more than the
#: most turns that they take.
FAMILY = 5
TAKEN = 9

_SUMS = ("s0", "s1", "s2", "s3")


def centroid_rollup(parent: np.ndarray, depth: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums of ``weights`` (nodes x kinds) over each node's subtree.

    ``parent`` is a place in the arrays, -1 for tops; nodes come by ascending ``depth``.
    """
    n = len(parent)
    sums = np.zeros_like(weights)
    alive = np.ones(n, bool)
    cuts = np.flatnonzero(np.diff(depth)) + 1
    levels = [np.arange(a, b) for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), n])]
    component = np.arange(n)
    while alive.any():
        linked = alive & (parent >= 0)
        linked[linked] = alive[parent[linked]]
        steps = [(level[linked[level]],) for level in levels]
        steps = [(nodes, parent[nodes]) for (nodes,) in steps if len(nodes)]
        np.copyto(component, np.arange(n))
        for nodes, above in steps:
            component[nodes] = component[above]
        size, total = alive.astype(np.int64), np.where(alive[:, None], weights, 0)
        for nodes, above in reversed(steps):
            np.add.at(size, above, size[nodes])
            np.add.at(total, above, total[nodes])
        # The nodes that hold half their component: the path from its top to the centroid.
        path = np.flatnonzero(alive & (2 * size >= size[component]))
        centroid = np.full(n, -1)
        np.maximum.at(centroid, component[path], path)
        sums[path] += total[centroid[component[path]]]
        alive[centroid[centroid >= 0]] = False
    return sums


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: (conv_id, length), and their turns (conv_id, place, a, b, bytes).

    Conversation c has the first h turns of conversation c - c % FAMILY, then its own
    after its first h; h is crc32 of c's decimal, modulo TAKEN. a and b are hashes of role
    and text.
    """
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")),
    )
    numbered = running_totals(rows, {"place": F.lit(1)}, ["turn", "role", "text"], group="conv_id")
    said = store(
        numbered.select(
            "conv_id", "place", F.xxhash64(F.lit(1), "role", "text").alias("a"),
            F.xxhash64(F.lit(2), "role", "text").alias("b"),
            F.octet_length("text").cast("bigint").alias("bytes"),
        ),
        "turns",
    )
    lengths = said.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % TAKEN
    convs = lengths.select("conv_id", "own", taken.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("first"))
    held = lengths.select(F.col("conv_id").alias("first"), F.col("own").alias("held"))
    convs = convs.join(held, "first", "left").withColumn("m", F.least("h", F.coalesce("held", F.lit(0).cast("bigint"))))
    convs = store(
        convs.select("conv_id", "first", "h", "m", (F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")),
        "conversations",
    )
    heads = said.where(F.col("place") < TAKEN - 1).withColumnRenamed("conv_id", "first")
    heads = convs.select("conv_id", "first", "h").join(heads, "first").where("place < h")
    tails = said.join(convs.select("conv_id", "h", "m"), "conv_id").where("place >= h")
    tails = tails.withColumn("place", F.col("m") + F.col("place") - F.col("h"))
    columns = ("conv_id", "place", "a", "b", "bytes")
    return convs.select("conv_id", "length"), heads.select(*columns).union(tails.select(*columns))


def _node_key(depth: Column, sums: list[Column]) -> list[Column]:
    return key128(depth, *sums)


def memberships(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """conv_id, left (turns below), depth, key_a, key_b, parent_a, parent_b, bytes: each
    node that a conversation starts with, the root too."""
    halves = []
    for seed in (1, 2):
        hashed = F.xxhash64(F.lit(seed), "place", "a", "b")
        halves += [hashed.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(hashed, 32)]
    added = dict(zip(_SUMS, halves))
    before = running_totals(turns, added, ["place"], group="conv_id")
    sums = [F.col(c) for c in _SUMS]
    after = [c + half for c, half in zip(sums, halves)]
    above = [c.alias(name) for c, name in zip(_node_key(F.col("place"), sums), ("parent_a", "parent_b"))]
    depth = F.col("place") + 1
    below = before.select("conv_id", depth.alias("depth"), *_node_key(depth, after), *above, "bytes")
    below = below.join(convs, "conv_id")
    zero = F.lit(0).cast("bigint")
    none = F.lit(None).cast("bigint")
    root = convs.select(
        "conv_id", zero.alias("depth"), *_node_key(zero, [zero] * len(_SUMS)),
        none.alias("parent_a"), none.alias("parent_b"), zero.alias("bytes"), "length",
    )
    rows = root.unionByName(below)
    left = (F.col("length") - F.col("depth")).alias("left")
    return store(rows.select("conv_id", left, "depth", "key_a", "key_b", "parent_a", "parent_b", "bytes"), "members")


def _ends(members: DataFrame) -> DataFrame:
    """key_a, key_b, ends_sha256 of nodes at which conversations end. A node's ids pass
    one task in order, and are hashed as they pass."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, hashlib.sha256()
        done: list[tuple] = []
        for batch in batches:
            keys = np.stack([batch.column("key_a").to_numpy(), batch.column("key_b").to_numpy()], axis=1)
            ids = batch.column("conv_id").to_pylist()
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for first, last in zip(cuts, cuts[1:]):
                if first == last:
                    continue
                listed = ",".join(map(str, ids[first:last])).encode()
                if node == (here := tuple(keys[first].tolist())):
                    state.update(b"," + listed)
                    continue
                if node:
                    done.append((*node, state.hexdigest()))
                node, state = here, hashlib.sha256(listed)
            if len(done) > 10_000:
                yield _ended(done)
                done = []
        if node:
            done.append((*node, state.hexdigest()))
        yield _ended(done)

    ended = members.where("left = 0").select("key_a", "key_b", "conv_id")
    ended = ended.repartition("key_a", "key_b").sortWithinPartitions("key_a", "key_b", "conv_id")
    return ended.mapInArrow(hashed, "key_a bigint, key_b bigint, ends_sha256 string")


def _ended(done: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string())
    columns = zip(*done) if done else ((),) * 3
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, kind in zip(columns, kinds)], ["key_a", "key_b", "ends_sha256"]
    )


def _light_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of whole subtrees, which come one after another by ascending depth."""
    held: list[pa.Table] = []

    def rolled(table: pa.Table) -> pa.RecordBatch:
        table = table.take(pa.compute.sort_indices(table, [("depth", "ascending")]))
        keys = list(zip(table.column("key_a").to_pylist(), table.column("key_b").to_pylist()))
        places = dict(zip(keys, range(len(keys))))
        above = zip(table.column("parent_a").to_pylist(), table.column("parent_b").to_pylist())
        parent = np.fromiter((places.get(key, -1) for key in above), np.int64, len(keys))
        weights = np.stack([table.column(c).to_numpy() for c in ("leaf", "saved")], axis=1)
        sums = centroid_rollup(parent, table.column("depth").to_numpy(), weights)
        return pa.RecordBatch.from_pydict(
            {c: table.column(c).combine_chunks() for c in ("key_a", "key_b")}
            | {c: np.ascontiguousarray(sums[:, i]) for i, c in enumerate(("n_leaves", "saved_tokens"))}
        )

    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        tops = np.stack([batch.column(c).to_numpy() for c in ("top_a", "top_b")], axis=1)
        starts = np.flatnonzero((tops[1:] != tops[:-1]).any(axis=1)) + 1
        if held:
            last = tuple(held[-1].column(c)[-1].as_py() for c in ("top_a", "top_b"))
            starts = starts if tuple(tops[0].tolist()) == last else np.r_[0, starts]
        if rows + batch.num_rows > LIGHT and held and len(starts):
            # Up to the last subtree that is known to be whole.
            whole = int(starts[-1])
            held.append(pa.Table.from_batches([batch.slice(0, whole)]))
            yield rolled(pa.concat_tables(held))
            held, rows = [pa.Table.from_batches([batch.slice(whole)])], batch.num_rows - whole
        else:
            held.append(pa.Table.from_batches([batch]))
            rows += batch.num_rows
    if held:
        yield rolled(pa.concat_tables(held))


def _path_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(batches)
    table = table.take(pa.compute.sort_indices(table, [("top_depth", "ascending")]))
    names = table.column("path").to_pylist()
    places = dict(zip(names, range(len(names))))
    parent = np.fromiter((places.get(p, -1) for p in table.column("above").to_pylist()), np.int64, len(names))
    weights = np.stack([table.column(c).to_numpy() for c in ("leaf", "saved")], axis=1)
    sums = centroid_rollup(parent, table.column("top_depth").to_numpy(), weights)
    yield pa.RecordBatch.from_pydict(
        {"path": pa.array(names, pa.int64())} | {c: np.ascontiguousarray(sums[:, i]) for i, c in enumerate(("leaf", "saved"))}
    )


def rollup(nodes: DataFrame, members: DataFrame, light: int) -> DataFrame:
    """key_a, key_b, n_leaves, saved_tokens: sums of leaf and saved of ``nodes`` over
    subtrees."""
    key = ["key_a", "key_b"]
    flagged = nodes.select(*key, (F.col("weight") >= light).alias("heavy"))
    rows = members.select("conv_id", "depth", *key).join(flagged, key)
    rows = store(rows, "sides")
    # Along a conversation heavy nodes come first: where it turns light is its subtree's top.
    turned = F.min_by(F.struct(*key), "depth")
    tops = rows.where("not heavy").groupBy("conv_id").agg(turned.alias("top"))
    small = nodes.where(F.col("weight") < light).join(tops, "conv_id").select(
        F.col("top.key_a").alias("top_a"), F.col("top.key_b").alias("top_b"),
        *key, "parent_a", "parent_b", "depth", "leaf", "saved",
    )
    small = small.repartition("top_a", "top_b").sortWithinPartitions("top_a", "top_b", "depth")
    schema = "key_a bigint, key_b bigint, n_leaves bigint, saved_tokens bigint"
    light_sums = store(small.mapInArrow(_light_sums, schema), "light")

    # A heavy node belongs to the path of the member that stays heavy longest: it ends in a leaf.
    heavy = rows.where("heavy")
    reach = heavy.groupBy("conv_id").agg(F.max("depth").alias("reach"))
    named = heavy.join(reach, "conv_id").groupBy(*key).agg(
        F.max(F.struct("reach", (-F.col("conv_id")).alias("minus"))).alias("best")
    )
    named = named.select(*key, (-F.col("best.minus")).alias("path"))
    from_light = light_sums.join(nodes.select(*key, "parent_a", "parent_b"), key).groupBy("parent_a", "parent_b").agg(
        F.sum("n_leaves").alias("more_leaf"), F.sum("saved_tokens").alias("more_saved")
    )

    def plus(table: DataFrame, more: DataFrame) -> DataFrame:
        more = more.withColumnsRenamed({"parent_a": "key_a", "parent_b": "key_b"})
        sums = {c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0).cast("bigint")) for c in ("leaf", "saved")}
        return table.join(more, key, "left").withColumns(sums).drop("more_leaf", "more_saved")

    spine = nodes.join(named, key).select(*key, "parent_a", "parent_b", "depth", "leaf", "saved", "path")
    # Sums of light subtrees count at their heavy parents; those of inner light nodes have none.
    spine = store(plus(spine, from_light), "heavy")
    paths = spine.groupBy("path").agg(
        F.min("depth").alias("top_depth"), F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"),
        F.min_by(F.struct("parent_a", "parent_b"), "depth").alias("at"),
    )
    above = spine.select(
        F.struct(F.col("key_a").alias("parent_a"), F.col("key_b").alias("parent_b")).alias("at"), F.col("path").alias("above")
    )
    paths = store(paths.join(above, "at", "left").select("path", "above", "top_depth", "leaf", "saved", "at"), "paths")
    totals = paths.select("path", "above", "top_depth", "leaf", "saved").coalesce(1).mapInArrow(
        _path_sums, "path bigint, leaf bigint, saved bigint"
    )
    from_paths = totals.select("path", F.col("leaf").alias("more_leaf"), F.col("saved").alias("more_saved")).join(
        paths.select("path", "at.parent_a", "at.parent_b"), "path"
    )
    from_paths = from_paths.groupBy("parent_a", "parent_b").agg(
        F.sum("more_leaf").alias("more_leaf"), F.sum("more_saved").alias("more_saved")
    )
    spine = plus(spine, from_paths).select(*key, "path", (-F.col("depth")).alias("up"), "leaf", "saved")
    below = running_totals(spine, {"n_leaves": "leaf", "saved_tokens": "saved"}, ["up"], group="path")
    return light_sums.union(
        below.select(*key, F.col("n_leaves") + F.col("leaf"), F.col("saved_tokens") + F.col("saved"))
    )


def prefix_trie(turns: DataFrame, light: int = LIGHT) -> DataFrame:
    """Per node: key_a, key_b, parent_a, parent_b, conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    key = ["key_a", "key_b"]
    members = memberships(*rebuilt_turns(turns))
    nodes = members.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("left").alias("weight"),
        *(F.first(c).alias(c) for c in ("depth", "parent_a", "parent_b", "bytes")),
    )
    children = nodes.where("parent_a is not null").groupBy("parent_a", "parent_b").agg(F.count(F.lit(1)).alias("n_children"))
    children = children.withColumnsRenamed({"parent_a": "key_a", "parent_b": "key_b"})
    none = F.lit(0).cast("bigint")
    nodes = nodes.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", none))
    nodes = store(
        nodes.withColumns(
            {"leaf": (F.col("n_children") == 0).cast("bigint"), "saved": (F.col("n_convs") - 1) * F.col("bytes")}
        ),
        "nodes",
    )
    rows = members.where("depth > 0").count()
    sums = rollup(nodes, members, max(light, math.isqrt(rows)))
    parents = nodes.select(
        F.col("key_a").alias("parent_a"), F.col("key_b").alias("parent_b"), F.col("conv_id").alias("parent_conv_id")
    )
    found = nodes.join(parents, ["parent_a", "parent_b"], "left").join(sums, key).join(_ends(members), key, "left")
    return found.select(
        *key, "parent_a", "parent_b", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def op13_prefix_trie(spark, conversations: DataFrame) -> DataFrame:
    return prefix_trie(conversations).drop("key_a", "key_b", "parent_a", "parent_b")
