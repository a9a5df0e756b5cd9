"""Toxicity by held-out accuracy; fingerprints against a plain version."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from shelfmark.llm import imatch, toxicity

from .conftest import documents, messy_rows, prose


def planted(n, seed):
    """Half of the texts hold insults, each spelt in a way of its own."""
    chosen = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = [w + chosen.choice("abcdefgh") * 2 for w in prose(seed * n + i, 60).split()]
        if i % 2:
            for _ in range(4):
                word = chosen.choice(["blockhead", "numskull", "scoundrel"])
                at = chosen.randrange(4, len(word) + 1)
                words[chosen.randrange(60)] = word[:at] + chosen.choice("xyzqk") + word[at:]
        texts.append(" ".join(words))
        labels.append(i % 2)
    return texts, labels


def test_unseen_spellings_are_found():
    model = toxicity.train(*planted(400, 1), toxicity.Settings(batch_words=5000, epochs=6, weight=1.0))
    texts, labels = planted(200, 2)
    predicted = model.score(texts, {}) >= 0.5
    assert sum(p == bool(y) for p, y in zip(predicted, labels)) >= 190


def test_labels_of_held_out_rows_are_not_used(spark):
    texts, labels = planted(120, 3)
    docs = documents(spark, texts)
    frame = spark.createDataFrame([(i, y) for i, y in enumerate(labels)], "doc_id bigint, toxic int")
    flipped = frame.withColumn(
        "toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    one, other = (
        {r["doc_id"]: r["score"] for r in toxicity.op3_toxicity(spark, docs.repartition(n), l).collect()}
        for n, l in ((2, frame), (5, flipped))
    )
    assert one == other
    got = toxicity.op3_toxicity(spark, docs, frame).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in got)


def test_fingerprints(spark, messy):
    texts = [prose(i, 10 + i % 50) for i in range(150)] + [prose(3, 13)] * 5
    docs = documents(spark, texts).repartition(6)
    known = imatch.lexicon(docs)
    got = sorted(imatch.compare_with_edits(docs, known).collect(), key=lambda r: r["doc_id"])
    assert len(got) == len(texts)
    for i, r in enumerate(got):
        text, following = texts[i], texts[(i + 1) % len(texts)]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        own, of_changed, of_next = (known.fingerprint(t) for t in (text, changed, following))
        assert tuple(r) == (
            i, len(text), hashlib.sha256(changed.encode()).hexdigest(), imatch.written(own),
            imatch.written(of_changed), imatch.likeness(own, of_changed), imatch.likeness(own, of_next),
        )
    assert len({r["fingerprint"] for r in got[150:]}) == 1
    assert got[-2]["near_next"] == 1
    rows = imatch.op9_imatch(spark, messy).collect()
    assert sorted((repr(r["doc_id"]), r["n_chars"]) for r in rows) == sorted((repr(r[0]), len(r[1] or "")) for r in messy_rows())


def test_frequencies_count_documents(spark):
    counts = imatch.document_frequencies(documents(spark, ["A a b", "b", None, "", "a"]))
    assert {r["term"]: r["documents"] for r in counts.collect()} == {"a": 2, "b": 2}


def test_the_sample_takes_one_text_of_an_id_and_bounded_bytes(spark):
    rows = [(1, f"text {i}") for i in range(500)] + [(2, "y" * 100), (3, None), (4, "z" * 50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 6)], "doc_id bigint, toxic int")
    kept = [i for i in range(1, 5) if zlib.crc32(str(i).encode()) % 5]
    texts, toxic = toxicity.training_sample(docs, labels)
    assert len(texts) == len(toxic) == len(kept)
    assert sum((t or "").startswith("text ") for t in texts) == (1 in kept)
    small, _ = toxicity.training_sample(docs, labels, toxicity.Settings(sample_bytes=60))
    assert sum(len(t or "") for t in small) <= 60 and len(small) < len(texts)


def test_subwords_are_of_letters():
    settings = toxicity.Settings(buckets=1 << 30)
    of = {zlib.crc32(x.encode()) % settings.buckets for x in ("<éß>", "<éß", "éß>")}
    assert set(toxicity.subwords("éß", settings)) == of
