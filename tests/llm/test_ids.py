"""Tokens, their shards, and packing, against the tokenizer run on whole texts."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfmark.llm import elias_fano, packing, tokens
from shelfmark.session import new_work_dir

from .conftest import documents, messy_rows, prose

ALPHABET = list("abc XYZ  .,'’!?|-_09½ éßñ\n\t\r\x0b\x1c\x1f\x85\xa0 　日本語Ωжя🙂́<>") + [
    "'s", "'ll", "'re", " 't", "<|endoftext|>", "İ",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(tokens.default_tokenizer())
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_equal_whole_texts(library, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED", 500)
    encoder = tokens.PieceEncoder(tokens.default_tokenizer())
    chosen = random.Random(1)
    texts = ["".join(chosen.choices(ALPHABET, k=chosen.randint(0, 60))) for _ in range(3000)]
    for first in range(0, len(texts), 100):
        part = texts[first : first + 100]
        assert [np.frombuffer(i, "<u4").tolist() for i in encoder.encode(part)] == [library(t) for t in part]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=700))
def test_elias_fano_round_trip(values):
    values = sorted(values)
    held = elias_fano.EliasFano.from_bytes(elias_fano.EliasFano.of(values).to_bytes())
    assert held.all().tolist() == values
    assert [held.select(i) for i in range(len(values))] == values


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 20_000))
    # Far less than a 64-bit table: near 2 + log2(universe / n) bits an entry.
    assert len(elias_fano.EliasFano.of(values).to_bytes()) < 1.9 * len(values)


def test_shards_read_back(spark, messy, library):
    folder = new_work_dir(spark, "ids")
    manifest = elias_fano.write_ids(messy, folder, tokens.default_tokenizer())
    got = elias_fano.read_ids(manifest).collect()
    start = 0
    for row in sorted(got, key=lambda r: r["start"]):
        assert row["start"] == start
        start += row["n_tokens"]
    want = sorted(
        (repr(r[0]), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for r in messy_rows() for ids in [library(r[1]) + [2]]
    )
    assert sorted((repr(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == want
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ids == sorted(ids, key=lambda d: (d is not None, d))
    shard = elias_fano.ShardReader(manifest.orderBy("shard").first()["uri"])
    assert sum(len(shard.document(i)) for i in range(shard.documents)) == shard.count


def test_packing_is_whole_and_balanced(spark, library):
    sources = ["a"] * 60 + ["b"] * 30 + [None] * 30
    texts = [prose(i, 20 + 13 * (i % 40)) for i in range(119)] + [None]
    pieces = packing.pack(documents(spark, texts, sources), tokens.default_tokenizer(), length=256, quanta=8, with_ids=True).collect()
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
    total = 0
    for doc_id, text in enumerate(texts):
        ids = np.array(library(text) + [1], "<u4")
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p["start"]):
            part = ids[at : at + p["length"]]
            assert (p["start"], p["doc_tokens"], p["source"]) == (at, len(ids), sources[doc_id])
            assert p["ids"] == part.tolist() and p["ids_crc32"] == zlib.crc32(part.tobytes())
            at += p["length"]
        assert at == len(ids)
        total += at
    windows = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        held = windows.setdefault(p["sequence_id"], {})
        assert p["offset"] == sum(held.values())
        held[p["source"]] = held.get(p["source"], 0) + p["length"]
    assert sorted(windows) == list(range(-(-total // 256)))
    assert all(sum(windows[w].values()) == 256 for w in range(total // 256))
    # The deficit carried from window to window stays within a few quanta.
    share = {s: sum(w.get(s, 0) for w in windows.values()) / total for s in set(sources)}
    taken = dict.fromkeys(share, 0)
    for number in range(total // 256):
        for s in share:
            taken[s] += windows[number].get(s, 0)
            assert abs(taken[s] - share[s] * 256 * (number + 1)) <= 2 * 32 * len(share)


def test_packing_follows_given_weights(spark):
    from pyspark.sql import functions as F

    docs = documents(spark, [prose(i, 200) for i in range(60)], ["a", "b"] * 30)
    weights = F.when(F.col("queue") == "=a", 3.0).otherwise(1.0)
    pieces = packing.pack(docs, tokens.default_tokenizer(), weights=weights, length=512).collect()
    early = [p for p in pieces if p["sequence_id"] < 20]
    share = sum(p["length"] for p in early if p["source"] == "a") / sum(p["length"] for p in early)
    assert abs(share - 0.75) < 0.02
