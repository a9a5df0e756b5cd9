"""Near duplicates, mixing and sharding against brute force."""

import math
import random
import zlib
from collections import Counter

import pytest

from shelfmark.llm import components, mixing, near_dedup, sharding

from .conftest import documents, messy_rows, prose


def shingle_set(text):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", words)]
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset(words)


def grouped(rows):
    """Smallest id reachable over pairs with 100 * both >= 80 * either."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    least = {i: i for i, _ in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for n, (i, s) in enumerate(sets):
        for j, r in sets[:n]:
            if s and r and 100 * len(s & r) >= 80 * len(s | r):
                a, b = sorted((root(i), root(j)))
                least[b] = a
    return {i: root(i) for i, _ in sets}


def test_near_duplicates(spark):
    chosen = random.Random(3)
    texts = [prose(i, 5 + i) for i in range(60)] + ["", None, "one", "One", "two", "THE a", "the A", "the a the a"]
    for share in (0.01, 0.03, 0.05, 0.1, 0.2):
        for seed in range(8):
            words = prose(200 + seed, 150).split()
            texts.append(" ".join(w if chosen.random() > share else f"new{chosen.random()}" for w in words))
    crowd = prose(7, 120).split()
    for i in range(150):
        copy = list(crowd)
        copy[i % 120] = f"other{i}"
        texts.append(" ".join(copy))
    texts += [texts[0]] * 40
    want = grouped(list(enumerate(texts)))
    got = near_dedup.op7_lsh_forest(spark, documents(spark, texts).repartition(5)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert all(r["n_shingles"] == len(shingle_set(texts[r["doc_id"]])) for r in got)


def test_rows_without_id_link_to_equal_sets(spark):
    rows = [(None, "a b c"), (None, "a b c"), (None, "z y x"), (4, "z y x"), (4, "z y x"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup.op7_lsh_forest(spark, docs).collect())
    assert got == {(None, None, True): 3, (None, 4, False): 1, (4, 4, True): 2}


@pytest.mark.parametrize("settled", [0, components.SETTLED])
def test_components_of_chains_and_stars(spark, settled):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(7, 7), (210, 205), (205, 203)]
    found = components.components(spark.createDataFrame(links, "a bigint, b bigint"), settled).collect()
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)} | {210: 203, 205: 203, 203: 203}
    assert {r["id"]: r["component"] for r in found} == want and len(found) == len(want)


def targets_in_python(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        level = (total - sum(capped.values())) / max(1, sum(weight[s] for s in free))
        over = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not over:
            return {s: capped.get(s, level * weight[s]) for s in order}
        capped |= {s: 3 * sizes[s] for s in over}


def test_mixing(spark):
    chosen = random.Random(5)
    names = ["a", "b", "c", "é", "z", None, "empty"]
    sources = [chosen.choice(names[:6]) if i % 3 else "b" for i in range(600)] + ["empty"] * 3
    texts = ["w " * int(chosen.paretovariate(1) * 8) for _ in range(600)] + [None, "", " "]
    docs = documents(spark, texts, sources)
    got = mixing.op5_mixing(spark, docs).collect()
    sizes = Counter()
    for t, s in zip(texts, sources):
        sizes[s] += len((t or "").split())
    want = targets_in_python(sizes)
    taken, largest = Counter(), Counter()
    for r in got:
        source = sources[r["doc_id"]]
        assert r["size"] == len((texts[r["doc_id"]] or "").split()) and r["source_size"] == sizes[source]
        assert math.isclose(r["target"], want[source], rel_tol=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"] and 0 <= r["copies"] <= 3
        taken[source] += r["taken"]
        largest[source] = max(largest[source], r["size"])
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(0.01 * target, largest[source] / 10)
    again = mixing.op5_mixing(spark, docs.repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    copies = Counter(r["doc_id"] for r in mixing.mixed_documents(docs).collect())
    assert copies == Counter({r["doc_id"]: r["copies"] for r in got if r["copies"]})


def test_rates_are_exponential_in_size(spark):
    cells = spark.createDataFrame([("=a", n, 50) for n in (5, 10, 20, 40)], "queue string, size bigint, n bigint")
    targets = spark.createDataFrame([("=a", 3750, 2500.0)], "queue string, source_size bigint, target double")
    solved = mixing.balance(cells, targets).first()
    taken = sum(50 * n * math.exp(solved["multiplier"] * n / solved["mean"]) for n in (5, 10, 20, 40))
    assert abs(taken - 2500) < 1e-3


def test_sharding(spark, messy):
    texts = [prose(i % 90, 5 + i % 37) for i in range(300)] + ["big " * 3000] * 3
    docs = documents(spark, texts)
    got = sharding.op10_sharding(spark, docs).collect()
    by_shard, of_text = {}, {}
    for r in got:
        text = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 8, zlib.crc32(text), "bytes", None)
        by_shard.setdefault(r["shard"], []).append(r)
        of_text.setdefault(text, set()).add(r["shard"])
    assert all(len(s) == 1 for s in of_text.values())
    assert all(sorted(r["slot"] for r in rows) == list(range(len(rows))) for rows in by_shard.values())
    # The heap over all groups, which fit one by one here.
    sizes = Counter()
    for t in texts:
        sizes[t] += len(t.encode()) + 8
    best = Counter()
    for size, shard in zip(sizes.values(), sharding.least_loaded(list(sizes.values()), 24)):
        best[shard] += size
    assert max(sum(r["size"] for r in rows) for rows in by_shard.values()) <= max(best.values()) * 1.02
    few = sharding.shard_documents(messy, shards=3, parts=2).collect()
    assert len(few) == len(messy_rows()) and {r["shard"] for r in few} <= {0, 1, 2}
