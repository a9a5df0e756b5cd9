"""The trie of conversations against one built from tuples."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from shelfmark.llm import prefix_trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id bigint, turn int, role string, text string, depth string, key_a string, n_convs string"


def brute(rows):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(turns)] for c, turns in said.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]
    members, children, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not children[node]
        if node:
            saved[node] += (len(members[node]) - 1) * len(node[-1][1].encode())
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    out = []
    for node, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(rebuilt[c]) == len(node))
        out.append(
            (
                min(of), len(node), min(members[node[:-1]]) if node else None, len(of), children[node],
                leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def talks():
    chosen = random.Random(2)
    rows = []
    for c in range(90):
        for turn in range(chosen.choice([0, 1, 2, 3, 5, 9, 14])):
            rows.append((c, turn, chosen.choice(["user", "assistant"]), chosen.choice("ab") * chosen.randint(1, 2)))
    # Long ones, one the beginning of others; nulls, repeated rows, far ids.
    rows += [(500 + 5 * c, turn, "u", f"x{turn % 3}") for c in range(3) for turn in range(200 - 40 * c)]
    rows += [(None, 1, "u", "t"), (-3, None, None, None), (-3, 1, "u", "é"), (-3, 1, "u", "é"), (-5, 2, "u", "z"), (1 << 60, 1, None, "")]
    return rows


@pytest.mark.parametrize("light", [prefix_trie.LIGHT, 3])
def test_trie(spark, light):
    rows = talks()
    turns = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).repartition(5)
    got = prefix_trie.prefix_trie(turns, light).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_no_conversations(spark):
    assert prefix_trie.op13_prefix_trie(spark, spark.createDataFrame([], SCHEMA)).collect() == []
    alone = spark.createDataFrame([(None, 1, "u", "t", "x", "x", "x")], SCHEMA)
    assert prefix_trie.op13_prefix_trie(spark, alone).collect() == []


@pytest.mark.parametrize("shape", ["chain", "star", "random", "forest"])
def test_rollup_by_centroids(shape):
    chosen = np.random.default_rng(4)
    n = 300
    parent = {
        "chain": np.arange(n) - 1, "star": np.r_[-1, np.zeros(n - 1, int)],
        "random": np.array([-1, *(chosen.integers(0, i) for i in range(1, n))]),
        "forest": np.array([chosen.integers(-1, i) for i in range(n)]),
    }[shape]
    depth = np.zeros(n, int)
    for i in range(n):
        depth[i] = depth[parent[i]] + 1 if parent[i] >= 0 else chosen.integers(0, 3)
    order = np.argsort(depth, kind="stable")
    place = np.empty(n, int)
    place[order] = np.arange(n)
    moved = np.where(parent[order] >= 0, place[parent[order]], -1)
    weights = chosen.integers(0, 100, (n, 2))
    want = weights.copy()
    for i in range(n - 1, -1, -1):
        if moved[i] >= 0:
            want[moved[i]] += want[i]
    assert (prefix_trie.centroid_rollup(moved, depth[order], weights) == want).all()
