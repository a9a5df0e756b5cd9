"""Registered queries that SQL cannot express, against what their results must be."""

import hashlib
import os
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__ as contract

from .test_alignment import brute

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect()
    return {r["doc_id"]: r for r in rows}


@pytest.fixture(scope="module")
def token_ids(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    return {i: library.encode(r["text"] or "", add_special_tokens=False).ids for i, r in docs.items()}


def rows_of(spark, name):
    return contract.queries()[name](spark, DATA).collect()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op3(spark, docs):
    rows = rows_of(spark, "op3_toxicity")
    assert sorted(r["doc_id"] for r in rows) == list(docs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_op4(spark, token_ids):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows_of(spark, "op4_packing"):
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert sorted(pieces) == list(token_ids)
    for doc_id, ids in token_ids.items():
        whole, at = [*ids, 1], 0
        for r in sorted(pieces[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(whole)
            at += r["length"]
            assert r["ids_crc32"] == crc(whole[r["start"] : at])
        assert at == len(whole)
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    padding = 2048 * len(sequences) - sum(len(ids) + 1 for ids in token_ids.values())
    assert padding < 2048


def test_op5(spark, docs):
    rows = rows_of(spark, "op5_mixing")
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for i, r in docs.items()}
    assert {r["doc_id"]: r["size"] for r in rows} == sizes
    of_source, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        source = docs[r["doc_id"]]["source"]
        of_source[source] += r["size"]
        taken[source] += r["taken"]
        target[source] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    left, total, want = sorted(of_source), sum(of_source.values()), {}
    while True:
        weights = {s: (5, 2, 1)[sorted(of_source).index(s) % 3] for s in left}
        share = (total - sum(want.values())) / sum(weights.values())
        over = [s for s in left if share * weights[s] > 3 * of_source[s]]
        if not over:
            break
        want |= {s: 3 * of_source[s] for s in over}
        left = [s for s in left if s not in over]
    want |= {s: share * weights[s] for s in left}
    for source, words in want.items():
        assert target[source] == pytest.approx(words)
        assert abs(taken[source] - words) <= max(0.02 * words, max(sizes.values()))


def test_op8(spark, token_ids):
    at = 0
    for r, (doc_id, ids) in zip(sorted(rows_of(spark, "op8_elias_fano"), key=lambda r: r["doc_id"]), token_ids.items()):
        assert tuple(r)[:4] == (doc_id, at, len(ids) + 1, crc([*ids, 2]))
        at += len(ids) + 1


def test_op9(spark, docs):
    texts = [r["text"] or "" for r in docs.values()]
    rows = sorted(rows_of(spark, "op9_imatch"), key=lambda r: r["doc_id"])
    prints = defaultdict(set)
    for i, (r, doc_id) in enumerate(zip(rows, docs, strict=True)):
        text, following = texts[i], texts[(i + 1) % len(texts)]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        assert (r["doc_id"], r["n_chars"]) == (doc_id, len(text))
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        prints[text].add(r["fingerprint"])
        if text == changed:
            assert r["near_edited"] == 1 and r["fingerprint"] == r["edited_fingerprint"]
        if text == following:
            assert r["near_next"] == 1
    assert all(len(p) == 1 for p in prints.values())


def test_op10(spark, docs):
    rows = rows_of(spark, "op10_sharding")
    shards, of_text = defaultdict(list), defaultdict(set)
    for r in rows:
        text = (docs[r["doc_id"]]["text"] or "").encode()
        assert r["size"] == len(text) + 8 and r["text_crc32"] == zlib.crc32(text) and 0 <= r["shard"] < 24
        shards[r["shard"]].append(r)
        of_text[text].add(r["shard"])
    assert sorted(r["doc_id"] for r in rows) == list(docs) and len({r["law"] for r in rows}) == 1
    assert all(sorted(r["slot"] for r in held) == list(range(len(held))) for held in shards.values())
    assert all(len(s) == 1 for s in of_text.values())


def test_op12(spark, docs):
    got = sorted((tuple(r) for r in rows_of(spark, "op12_alignment")), key=str)
    assert got == brute([(i, r["text"]) for i, r in docs.items()])
