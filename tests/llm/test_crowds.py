"""Near duplicates of crowded regions against brute force."""

import random

import numpy as np
import pytest

from shelfmark.llm import near_dedup

from .conftest import documents
from .test_groups import grouped


def star(chosen, name, copies, hub_at, words, share):
    """Copies of a hub that are like it and hardly like each other, the hub among them."""
    hub = [f"{name}{chosen.randrange(10**9)}" for _ in range(words)]
    texts = []
    for i in range(copies):
        copy = list(hub)
        for at in chosen.sample(range(words), int(share * words)):
            copy[at] = f"{name}new{chosen.randrange(10**9)}"
        texts.append(" ".join(copy))
    return texts[:hub_at] + [" ".join(hub)] + texts[hub_at:]


def test_crowds_are_compared_whole(spark, monkeypatch):
    chosen = random.Random(9)
    texts = star(chosen, "s", 150, 75, 400, 0.05) + star(chosen, "t", 60, 60, 200, 0.05)
    # Near copies in pairs among documents that share much boilerplate.
    shared = [f"b{i}" for i in range(160)]
    for i in range(60):
        own = [f"own{i}x{k}" for k in range(60)]
        texts += [" ".join(shared + own), " ".join(shared + own[:-3] + ["end", f"e{i}"])]
    want = grouped(list(enumerate(texts)))
    assert len(set(want.values())) == 62
    for block in (near_dedup.BLOCK, 16):
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        got = near_dedup.op7_lsh_forest(spark, documents(spark, texts).repartition(4)).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == want


@pytest.mark.parametrize("sizes", [(70, 41), (30, 0), (1, 1)])
def test_overlaps(sizes):
    chosen = np.random.default_rng(1)
    core = chosen.integers(0, 1 << 62, 300).astype(np.uint64)

    def sets(n):
        own = [chosen.integers(0, 1 << 62, 20).astype(np.uint64) for _ in range(n)]
        return [np.unique(np.r_[core[chosen.random(300) < p], x, chosen.choice(core[:50], 5)]) for p, x in zip(chosen.random(n), own)]

    left, right = (sets(n) for n in sizes)
    got = near_dedup.overlaps(left, right or None)
    want = np.array([[len(np.intersect1d(a, b)) for b in right or left] for a in left])
    alone = np.eye(len(left), dtype=bool) if not right else np.zeros(want.shape, bool)
    assert (got == want)[~alone].all()


def test_a_forest_connects_what_is_linked():
    chosen = np.random.default_rng(2)
    for itself in (True, False):
        for share in (0.002, 0.02, 0.5):
            linked = chosen.random((60, 60 if itself else 45)) < share
            if itself:
                linked |= linked.T
                np.fill_diagonal(linked, False)
            forest = near_dedup.spanning_forest(linked, itself)
            assert len(forest) < sum(linked.shape) and all(linked[i, j] for i, j in forest)
            assert parts(forest, linked.shape, itself) == parts(np.argwhere(linked).tolist(), linked.shape, itself)


def parts(links, shape, itself):
    least = list(range(sum(shape)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, j in links:
        a, b = sorted((root(i), root(j if itself else shape[0] + j)))
        least[b] = a
    return [root(i) for i in range(len(least))]


def test_alike_but_not_near_costs_no_rows(spark):
    """Documents that share much and are not near duplicates: no links, few rows."""
    shared = [f"b{i}" for i in range(300)]
    texts = [" ".join(shared + [f"own{i}x{k}" for k in range(43)]) for i in range(400)]
    got = near_dedup.op7_lsh_forest(spark, documents(spark, texts).repartition(4)).collect()
    assert all(r["component_id"] == r["doc_id"] for r in got) and len(got) == 400
