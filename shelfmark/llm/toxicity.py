"""Toxicity by subword embeddings averaged into a linear softmax.

A word is the mean of the vectors of its character n-grams (hashed) and a document
the mean of its words; vectors and softmax are trained together. A misspelling never
seen shares most n-grams with the word it stands for, and so its vector.

Training takes a bounded sample of labelled documents, ``Settings.sample``, to the
driver: at most that many of label 1, ``Settings.clean`` times as many of label 0, by
the hash of doc_id, one text for each, and at most ``Settings.sample_bytes`` of texts.
Everything is scored
by the executors. A document's logit is linear in its words, so a word is worked out
once, as one number, and looked up after that.

Every row of ``documents`` is scored, rows that share a doc_id each by its own text; a
null or empty text has no words and scores by the bias alone, a very long one like any
other. No column but doc_id and text is read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import text_slices
from shelfmark.session import share

_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Settings:
    #: Most labelled documents of label 1 in training, and of label 0 for each of them.
    sample: int = 2600
    clean: int = 2
    #: Most bytes of their texts; a text that does not fit is left out.
    sample_bytes: int = 128 << 20
    #: What a toxic document counts in the loss: missing one is worse than a false alarm.
    weight: float = 3.0
    buckets: int = 1 << 16
    dim: int = 8
    grams: tuple[int, ...] = (3, 4, 5)
    epochs: int = 6
    batch_words: int = 60_000
    rate: float = 0.05
    seed: int = 7


def words_of(text: str | None) -> set[str]:
    """Each word counts once, so neither repeats nor function words drown the others."""
    return set(_WORD.findall(text.lower())) if text else set()


def subwords(word: str, settings: Settings) -> list[int]:
    """Buckets of a word's n-grams, its ends marked, and of the word itself."""
    marked = f"<{word}>"
    found = [zlib.crc32(marked.encode())]
    for n in settings.grams:
        found += [zlib.crc32(marked[i : i + n].encode()) for i in range(len(marked) - n + 1)]
    return [f % settings.buckets for f in found]


class Model:
    """What scoring needs: a number for each bucket, and the bias."""

    def __init__(self, settings: Settings, weights: np.ndarray, bias: float):
        self.settings, self.weights, self.bias = settings, weights, bias

    def word_logits(self, words: list[str]) -> list[float]:
        parts = [subwords(w, self.settings) for w in words]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = np.fromiter((b for p in parts for b in p), np.int64, int(sizes.sum()))
        sums = np.add.reduceat(self.weights[flat], np.cumsum(sizes) - sizes)
        return (sums / sizes).tolist()

    def score(self, texts: list[str | None], known: dict[str, float]) -> np.ndarray:
        split = [words_of(t) for t in texts]
        if len(known) > 400_000:
            known.clear()
        new = list(set().union(*split).difference(known))
        if new:
            known.update(zip(new, self.word_logits(new)))
        logits = [sum(map(known.__getitem__, ws)) / len(ws) if ws else 0.0 for ws in split]
        return 1 / (1 + np.exp(-np.clip(np.array(logits) + self.bias, -40, 40)))


def train(texts: list[str | None], labels: list[int], settings: Settings = Settings()) -> Model:
    """Vectors and softmax fitted together by Adam. Without both labels the score is
    the share of label 1 among the labels, 0 if there are none."""
    wanted = np.array(labels, float)
    if len(set(labels)) < 2:
        share_of = float(wanted.mean()) if len(wanted) else 0.0
        return Model(settings, np.zeros(settings.buckets), 40.0 if share_of else -40.0)
    vocabulary: dict[str, int] = {}
    ids, sizes = [], []
    for text in texts:
        words = sorted(words_of(text))
        ids.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int64))
        sizes.append(len(words))
    parts = [np.array(subwords(w, settings), np.int32) for w in vocabulary]
    vocabulary.clear()
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    offsets = np.cumsum(lengths) - lengths
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    del parts

    random = np.random.default_rng(settings.seed)
    vectors = random.uniform(-1, 1, (settings.buckets, settings.dim)) / settings.dim
    softmax = np.zeros((settings.dim + 1, 2))
    softmax[:-1] = random.normal(0, 1, (settings.dim, 2))
    moments = [np.zeros_like(a) for a in (vectors, vectors, softmax, softmax)]
    step = 0
    usable = [i for i, n in enumerate(sizes) if n]
    for _ in range(settings.epochs):
        for batch in _batches(random.permutation(usable).tolist(), sizes, settings.batch_words):
            step += 1
            rows = np.repeat(np.arange(len(batch)), [len(ids[i]) for i in batch])
            share_of = 1.0 / np.array([sizes[i] for i in batch])[rows]
            words, at = np.unique(np.concatenate([ids[i] for i in batch]), return_inverse=True)
            size = lengths[words]
            ends = np.cumsum(size)
            buckets = flat[np.repeat(offsets[words] - (ends - size), size) + np.arange(ends[-1])]
            word = np.add.reduceat(vectors[buckets], ends - size) / size[:, None]
            document = _sum_rows(word[at] * share_of[:, None], rows, len(batch))
            full = np.hstack([document, np.ones((len(batch), 1))])
            logits = full @ softmax
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            odds /= odds.sum(axis=1, keepdims=True)
            odds[np.arange(len(batch)), wanted[batch].astype(int)] -= 1
            odds *= np.where(wanted[batch] == 1, settings.weight, 1.0)[:, None] / len(batch)
            to_document = odds @ softmax[:-1].T
            to_word = _sum_rows(to_document[rows] * share_of[:, None], at, len(words)) / size[:, None]
            to_vectors = _sum_rows(np.repeat(to_word, size, axis=0), buckets, settings.buckets)
            for held, gradient, place in ((vectors, to_vectors, 0), (softmax, full.T @ odds, 2)):
                first, second = moments[place], moments[place + 1]
                first += 0.1 * (gradient - first)
                second += 0.01 * (gradient**2 - second)
                scale = settings.rate * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                held -= scale * first / (np.sqrt(second) + 1e-8)
    direction = softmax[:, 1] - softmax[:, 0]
    return Model(settings, vectors @ direction[:-1], float(direction[-1]))


def _batches(order: list[int], sizes: list[int], most: int) -> Iterator[list[int]]:
    batch: list[int] = []
    held = 0
    for i in order:
        batch.append(i)
        held += sizes[i]
        if held >= most:
            yield batch
            batch, held = [], 0
    if batch:
        yield batch


def _sum_rows(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(at, values[:, d], n) for d in range(values.shape[1])], axis=1)


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learnt from; a null doc_id counts as empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def training_sample(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()):
    """Texts and labels of a bounded sample, the same in every run.

    A doc_id with several labels is toxic if one of them says so; null labels and ids
    are left out. Of rows that share a doc_id one text is taken. Texts are taken in the
    order of a hash of the id as long as ``sample_bytes`` are not exceeded.
    """
    known = labels.select("doc_id", "toxic").where("doc_id is not null and toxic is not null")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = []
    for label in (0, 1):
        of_label = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id")
        most = settings.sample * (1 if label else settings.clean)
        chosen += of_label.limit(most).collect()
    ids = docs.sparkSession.createDataFrame(
        [(r["doc_id"], int(r["toxic"])) for r in chosen], "doc_id bigint, toxic int"
    )
    # One text for each id, however many rows share it.
    one = F.min_by("text", F.xxhash64("text")).alias("text")
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(
        one, F.first("toxic").alias("toxic")
    )
    # Sizes first: a row for each chosen id.
    sizes = rows.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")).collect()
    room, fit = settings.sample_bytes, []
    for row in sorted(sizes, key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"])):
        if row["size"] <= room:
            room -= row["size"]
            fit.append((row["doc_id"],))
    fit = docs.sparkSession.createDataFrame(fit, "doc_id bigint")
    rows = rows.join(F.broadcast(fit), "doc_id", "left_semi").collect()
    rows.sort(key=lambda r: r["doc_id"])
    return [r["text"] for r in rows], [r["toxic"] for r in rows]


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row; a text without words scores by the bias alone."""
    shared = share(docs.sparkSession, model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in text_slices(batches):
            scores = shared.value.score(batch.column("text").to_pylist(), known)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": scores})

    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return read.mapInArrow(score, "doc_id bigint, score double")


def op3_toxicity(spark, docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(*training_sample(docs, labels))
    scored = score_toxicity(docs, model)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
