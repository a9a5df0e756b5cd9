"""I-Match fingerprints: documents known by their terms of middling frequency.

The lexicon is the band of terms that stand in at least ``Band.least`` and at most
``Band.most`` of the documents, a band of inverse document frequency. Its size does not
grow with the corpus: each term fills the share ``least`` of the documents, so there
are at most (distinct terms of a mean document) / least of them. That is counted
before it is sent to the executors.

A document's lexicon terms, distinct and sorted, are hashed whole for each of several
randomised subsets of the lexicon. The subsets keep different shares of it, from two
thirds to one in 512: the large ones agree only for (nearly) equal documents, the
small ones also for documents that share much. Likeness is the share of equal hashes
among the subsets of which either document has a term.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import store, text_slices
from shelfmark.session import share

_WORD = re.compile(r"\w+")
#: Shares of the lexicon that the subsets keep, and subsets of each share.
KEPT = (2 / 3, 1 / 4, 1 / 16, 1 / 64, 1 / 256, 1 / 512)
EACH = 4
EMPTY = "-"


@dataclass(frozen=True)
class Band:
    least: float = 0.002
    most: float = 0.2
    #: Most terms that are sent to the executors; more raise an error.
    terms: int = 2_000_000


def terms_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, documents) over all rows of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in text_slices(batches):
            for text in batch.column("text").to_pylist():
                held.update(terms_of(text))
            if len(held) > 300_000:
                yield _counted(held)
                held = Counter()
        if held:
            yield _counted(held)

    partial = docs.select("text").mapInArrow(count, "term string, documents bigint")
    return partial.groupBy("term").agg(F.sum("documents").alias("documents"))


def _counted(held: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"term": list(held), "documents": list(held.values())})


class Lexicon:
    """The band's terms and which subsets hold each."""

    def __init__(self, terms: list[str]):
        self.masks = {term: _mask(term) for term in terms}

    def fingerprint(self, text: str | None) -> list[int | None]:
        """A 32-bit hash for each subset; None where the text has no term of it."""
        found = sorted(terms_of(text) & self.masks.keys())
        if not found:
            return [None] * (len(KEPT) * EACH)
        masks = np.fromiter(map(self.masks.__getitem__, found), np.uint32, len(found))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
        out = []
        for subset in range(len(KEPT) * EACH):
            chosen = hashes[(masks >> np.uint32(subset)) & np.uint32(1) == 1]
            out.append(xxhash.xxh32_intdigest(chosen.tobytes()) if len(chosen) else None)
        return out


def _mask(term: str) -> int:
    mask = 0
    for subset in range(len(KEPT) * EACH):
        if xxhash.xxh3_64_intdigest(term, seed=subset + 1) < KEPT[subset // EACH] * 2.0**64:
            mask |= 1 << subset
    return mask


def likeness(one: list[int | None], other: list[int | None]) -> float:
    """Equal hashes among subsets that either has terms of; 1 if neither has any."""
    pairs = [(a, b) for a, b in zip(one, other) if a is not None or b is not None]
    return sum(a == b for a, b in pairs) / len(pairs) if pairs else 1.0


def written(fingerprint: list[int | None]) -> str:
    return ".".join(EMPTY if h is None else f"{h:08x}" for h in fingerprint)


def lexicon(docs: DataFrame, band: Band = Band()) -> Lexicon:
    rows = docs.count()
    counts = store(document_frequencies(docs), "terms")
    inside = counts.where(
        (F.col("documents") >= max(2, band.least * rows)) & (F.col("documents") <= max(2, band.most * rows))
    ).select("term")
    size = inside.count()
    if size > band.terms:
        raise ValueError(f"{size} terms lie in the band; narrow it or allow for more")
    return Lexicon(sorted(r["term"] for r in inside.collect()))


def edited(text: str, following: str) -> str:
    """The last half of the text gives way to as much of the beginning of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


class _Rows:
    """Result rows of documents whose next one is known."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, text: str, own: list, following: str, next_own: list) -> None:
        changed = edited(text, following)
        of_changed = self.lexicon.fingerprint(changed)
        digest = hashlib.sha256(changed.encode()).hexdigest()
        self.rows.append(
            (doc_id, len(text), digest, written(own), written(of_changed), likeness(own, of_changed),
             likeness(own, next_own))
        )

    def take(self) -> list[pa.Array]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        columns = zip(*self.rows) if self.rows else [()] * len(types)
        found = [pa.array(c, t) for c, t in zip(columns, types)]
        self.rows = []
        return found


def compare_with_edits(docs: DataFrame, known: Lexicon) -> DataFrame:
    """RESULT of every row: its fingerprint against that of its edited text and that of
    the next document, in ascending doc_id order (nulls first, equal ids by hash).

    A null text is as an empty one. Documents are sorted by ranges; where a range ends,
    the next document is the first of the range after it (of the first range at the
    end), so the last document of each range waits for a second, small step.
    """
    shared = share(docs.sparkSession, known)
    names = [c.split()[0] for c in RESULT.split(", ")]

    def batch_of(made: _Rows, part: int, kind: str, doc_id=None, text=None) -> pa.RecordBatch:
        columns = made.take()
        n = len(columns[0]) if kind == "row" else 1
        if kind != "row":
            columns = [pa.array([doc_id], pa.int64()), *(pa.nulls(1, c.type) for c in columns[1:])]
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * n, pa.int64()), pa.array([kind] * n), *columns, pa.array([text] * n, pa.string())],
            names=["part", "kind", *names, "text"],
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        made, last = _Rows(shared.value), None
        for batch in text_slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                own = made.lexicon.fingerprint(text)
                if last is None:
                    yield batch_of(made, part, "head", doc_id, text)
                else:
                    made.add(*last, text, own)
                last = doc_id, text, own
            yield batch_of(made, part, "row")
        if last is not None:
            yield batch_of(made, part, "open", last[0], last[1])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _Rows(shared.value)
        for batch in batches:
            for doc_id, text, following in zip(*(c.to_pylist() for c in batch.columns)):
                own, next_own = (made.lexicon.fingerprint(t) for t in (text, following))
                made.add(doc_id, text, own, following, next_own)
            yield pa.RecordBatch.from_arrays(made.take(), names=names)

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = ("doc_id", F.xxhash64("text"))
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    found = store(
        ordered.mapInArrow(compare, f"part bigint, kind string, {RESULT}, text string"), "fingerprints"
    )
    # One head and one open row for each range.
    along = Window.orderBy("part")
    every = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("text").over(along), F.first("text").over(every))
    heads = found.where("kind = 'head'").select("part", following.alias("following"))
    waiting = found.where("kind = 'open'").join(heads, "part").select("doc_id", "text", "following")
    return found.where("kind = 'row'").select(*names).union(waiting.mapInArrow(close, RESULT))


def op9_imatch(spark, docs: DataFrame) -> DataFrame:
    return compare_with_edits(docs, lexicon(docs))
