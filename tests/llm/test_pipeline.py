"""The pipeline's stages on planted cases, one after the other."""

import numpy as np

import corpus_pipeline
from shelfmark.llm.common import store

from .conftest import documents, prose


def test_stages(spark):
    clean = ["the of and to " + prose(i, 80) for i in range(40)]
    line = "This very line stands in many of the documents here"
    lined = ["the of and to " + prose(100 + i, 60) + "\n" + line for i in range(6)]
    words = ("the of and to " + prose(300, 200)).split()
    near = [" ".join(words[:i] + ["odd"] + words[i + 1 :]) for i in range(5)]
    junk = ["spam " * 50, "too short", "# " * 100]
    texts = clean + lined + near + junk
    docs = documents(spark, texts, [f"s{i % 4}" for i in range(len(texts))])
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, ""), "stage")
        kept[name] = docs.collect()
    ids = {name: [r["doc_id"] for r in rows] for name, rows in kept.items()}
    good = len(clean) + len(lined) + len(near)
    assert sorted(ids["quality rules"]) == list(range(good))
    assert sorted(ids["line dedup"]) == list(range(good))
    assert sum(line in r["text"] for r in kept["line dedup"]) == 1
    assert all(r["n_chars"] == len(r["text"]) for r in kept["line dedup"])
    first_near = len(clean) + len(lined)
    assert sorted(ids["MinHash near-dedup"]) == list(range(first_near + 1))
    mixed = ids["mixing to target weights"]
    assert set(mixed) <= set(range(first_near + 1)) and max(map(mixed.count, mixed)) <= 3
    starts = [r for r in kept["packing"] if r["start"] == 0]
    assert sorted(r["doc_id"] for r in starts) == sorted(mixed)
    assert all(len(r["ids"]) == r["length"] for r in kept["packing"])
    assert np.all([r["offset"] + r["length"] <= 2048 for r in kept["packing"]])


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and set(corpus_pipeline.run(spark, "/root/testdata/sf0.001").columns) >= {"doc_id", "sequence_id", "ids"}
