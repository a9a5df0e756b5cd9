"""Tokens of two tokenizers aligned by the bytes that they cover.

Tokenizer A is a byte-level BPE of the ``tokenizers`` library, B a BPE of
``sentencepiece``; both read the text after a space. Where tokens of both end at the same
byte, a cut; between cuts lie groups of tokens that cover the same bytes. All pairs of an
A and a B token of a group are linked.

Cuts are found in lockstep: one vector of pointers into the A ends and one into the B
ends, a lane for every document of a batch (long documents have a lane for every
``LANE`` bytes). Each step compares the ends under all pointers at once, emits the cuts
and the links they close, and advances whichever end is behind; lanes that are through
are removed from the vectors.

Counts of id pairs over all documents. Documents are dealt into blocks of bounded size. A
block tells each of its pairs once, with the number of its documents that link it; the
sums are joined back to the blocks that asked, and a block's documents meet its answers
in one task. So nothing is broadcast, and a task holds one block.

Documents whose text is null or empty, or whose A or B tokens do not give back the space
and the text byte by byte, have no tokens: all numbers 0, no groups. No column but doc_id
and text is read; each row, repeated or not, is a document, and is returned once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import store, text_slices
from shelfmark.llm.tokens import _LATIN, PieceEncoder, default_tokenizer

#: Bytes of a lane, and most bytes of text of a block.
LANE = 2048
BLOCK = 32 << 20
#: Links of a group that are made one by one; larger groups are counted by distinct ids.
LISTED = 4096
#: Most pieces in each of the B cache's two generations.
CACHED = 300_000
#: Pairs that a task holds before it adds equal ones up.
HELD = 1 << 21

_SPACE = "▁"


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class WordPieces:
    """Texts to B ids, by a cache of the parts that no token crosses.

    A token holds a space only at its start or among spaces, so a text can be cut before
    each run of spaces. If no token of the vocabulary joins Latin letters with anything
    but spaces before them, it is cut around runs of these letters too.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        #: Bytes of each token; None for tokens that stand for no text.
        self.bytes: list[bytes | None] = []
        pieces = []
        for i in range(n):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif self.model.is_control(i) or self.model.is_unknown(i):
                self.bytes.append(None)
            else:
                self.bytes.append(piece.replace(_SPACE, " ").encode())
                pieces.append(piece)
        mixed = re.compile(f"[{_LATIN}][^{_LATIN}]|[^{_LATIN}{_SPACE}][{_LATIN}]")
        inner = re.compile(f"[^{_SPACE}]{_SPACE}")
        if any(inner.search(p) or "\n" in p for p in pieces):
            raise ValueError(f"tokens of {path} go on after spaces or hold line breaks")
        letters = not any(mixed.search(p) for p in pieces)
        self.parts = re.compile(f" *(?:[{_LATIN}]+|[^{_LATIN} ]+)| +" if letters else " *[^ ]+| +")
        self.lead = len(self.model.encode("\n"))
        self.young: dict[str, np.ndarray | None] = {}
        self.old: dict[str, np.ndarray | None] = {}

    def encode(self, texts: Sequence[str]) -> list[bytes | None]:
        """Ids of texts that begin with a space, as unsigned 32-bit integers; None where
        their bytes do not give back the text."""
        split = [self.parts.findall(text) for text in texts]
        if len(self.young) > CACHED:
            self.old, self.young = self.young, {}
        self._learn(set().union(*split).difference(self.young))
        known = self.young
        found = []
        for parts in split:
            ids = [known[p] for p in parts]
            found.append(None if None in ids else b"".join(ids))
        return found

    def _learn(self, parts: set[str]) -> None:
        new = []
        for part in parts:
            if part in self.old:
                self.young[part] = self.old[part]
            else:
                new.append(part)
        for first in range(0, len(new), 8192):
            some = new[first : first + 8192]
            # The model puts a space before a text; a line break keeps it from the part.
            asked = ["\n" + part for part in some]
            for part, ids in zip(some, self.model.encode(asked, num_threads=1)):
                ids = ids[self.lead :]
                held = [self.bytes[i] for i in ids]
                same = None not in held and b"".join(held) == part.encode()
                self.young[part] = np.array(ids, "<u4").tobytes() if same else None


class Aligner:
    """Batches of texts to counts, groups and linked id pairs."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = PieceEncoder(path_a), WordPieces(path_b)
        size = self.a.tokenizer.get_vocab_size()
        self.lengths_a = np.zeros(size, np.int64)
        for token, i in self.a.tokenizer.get_vocab().items():
            self.lengths_a[i] = len(token)
        self.lengths_b = np.array([len(b or b"") for b in self.b.bytes], np.int64)
        self.n_b = len(self.lengths_b)
        most = max(size, self.n_b)
        self.width = len(str(most)) + 1
        self.digits = np.zeros((most, self.width), np.uint8)
        self.n_digits = np.zeros(most, np.int64)
        for i in range(most):
            text = str(i).encode()
            self.digits[i, : len(text)] = list(text)
            self.n_digits[i] = len(text)

    def encode(self, texts: Sequence[str | None]) -> tuple[list[bytes], list[bytes]]:
        """A and B ids of each text; both empty if one does not give back the text."""
        spaced = [" " + t if t else "" for t in texts]
        one, other = self.a.encode(spaced), self.b.encode(spaced)
        for i, (text, a, b) in enumerate(zip(spaced, one, other)):
            # A's tokens are runs of the text's bytes, in order: nothing but a gap could differ.
            if b is None or self.lengths_a[np.frombuffer(a, "<u4")].sum() != len(text.encode()):
                one[i] = other[i] = b""
        return one, other

    def align(self, texts: Sequence[str | None]) -> dict[str, np.ndarray | list]:
        one, other = self.encode(texts)
        n_a = np.array([len(x) // 4 for x in one], np.int64)
        n_b = np.array([len(x) // 4 for x in other], np.int64)
        a = np.frombuffer(b"".join(one), "<u4").astype(np.int64)
        b = np.frombuffer(b"".join(other), "<u4").astype(np.int64)
        # Documents lie one after another: each ends at a cut.
        ends_a, ends_b = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
        stops = np.r_[0, np.cumsum(n_a)]
        last_a, last_b = lockstep(ends_a, ends_b, np.r_[0, ends_a][stops])
        groups = Groups(last_a, last_b)
        of_doc = np.searchsorted(stops, last_a, "right") - 1
        n = len(texts)
        n_groups = np.bincount(of_doc, minlength=n)
        links = np.bincount(of_doc, weights=groups.n_a * groups.n_b, minlength=n).astype(np.int64)
        docs, pairs, times = groups.pairs(a, b, of_doc, self.n_b)
        bounds = np.searchsorted(docs, np.arange(n + 1))
        return {
            "n_a": n_a, "n_b": n_b, "n_groups": n_groups.astype(np.int64), "n_links": links,
            "groups_sha256": self._digests(a, b, groups, n_groups),
            "pairs": pairs, "times": times, "bounds": bounds,
        }

    def spelled(self, a: np.ndarray, b: np.ndarray, groups: Groups, n_groups: np.ndarray) -> tuple[bytes, np.ndarray]:
        """``a1,a2|b1;a3|b2,b3`` of all documents, and where each begins and ends."""
        ids = np.empty(len(a) + len(b), np.int64)
        marks = np.full(len(ids), ord(","), np.uint8)
        at_a = np.arange(len(a)) + np.repeat(groups.first_b, groups.n_a)
        at_b = np.arange(len(b)) + np.repeat(groups.first_a + groups.n_a, groups.n_b)
        ids[at_a], ids[at_b] = a, b
        marks[at_a[groups.first_a + groups.n_a - 1]] = ord("|")
        ends = at_b[groups.first_b + groups.n_b - 1]
        marks[ends] = ord(";")
        sizes = self.n_digits[ids]
        rows = self.digits[ids]
        rows[np.arange(len(ids)), sizes] = marks
        text = rows[np.arange(self.width) <= sizes[:, None]].tobytes()
        through = np.r_[0, np.cumsum(sizes + 1)]
        last = np.r_[0, ends + 1][np.r_[0, np.cumsum(n_groups)]]
        return text, through[last]

    def _digests(self, a: np.ndarray, b: np.ndarray, groups: Groups, n_groups: np.ndarray) -> list[str]:
        text, bounds = self.spelled(a, b, groups, n_groups)
        held = memoryview(text)
        # Without the mark after a document's last group.
        return [
            hashlib.sha256(held[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(bounds, bounds[1:])
        ]


class Groups:
    """Groups of tokens, from the last A and B token of each."""

    def __init__(self, last_a: np.ndarray, last_b: np.ndarray):
        self.first_a, self.first_b = np.r_[0, last_a[:-1] + 1], np.r_[0, last_b[:-1] + 1]
        if not len(last_a):
            self.first_a = self.first_b = last_a
        self.n_a, self.n_b = last_a - self.first_a + 1, last_b - self.first_b + 1

    def pairs(self, a: np.ndarray, b: np.ndarray, docs: np.ndarray, n_b: int) -> tuple[np.ndarray, ...]:
        """Documents, distinct pairs (A id times ``n_b`` plus B id) and how many links
        each stands for; by document and pair."""
        links = self.n_a * self.n_b
        few = np.flatnonzero(links <= LISTED)
        group = np.repeat(few, links[few])
        nth = np.arange(len(group)) - np.repeat(np.cumsum(links[few]) - links[few], links[few])
        width = self.n_b[group]
        keys = a[self.first_a[group] + nth // width] * n_b + b[self.first_b[group] + nth % width]
        keys, times = np.unique(docs[group] << 32 | keys, return_counts=True)
        for g in np.flatnonzero(links > LISTED):
            one, n_one = np.unique(a[self.first_a[g] :][: self.n_a[g]], return_counts=True)
            other, n_other = np.unique(b[self.first_b[g] :][: self.n_b[g]], return_counts=True)
            keys = np.r_[keys, (docs[g] << 32 | one[:, None] * n_b + other[None, :]).ravel()]
            times = np.r_[times, (n_one[:, None] * n_other[None, :]).ravel()]
            keys, times = _added(keys, times)
        return keys >> 32, keys & 0xFFFFFFFF, times


def _added(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys as one, their times added up."""
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(times, starts) if len(keys) else times


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the A and B tokens that end at the same byte, in order.

    ``bounds`` are the bytes at which documents begin and end.
    """
    sizes = np.diff(bounds)
    lanes = -(-sizes // LANE)
    nth = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    start = np.repeat(bounds[:-1], lanes) + nth * LANE
    stop = np.minimum(start + LANE, np.repeat(bounds[1:], lanes))
    a, b = np.searchsorted(ends_a, start, "right"), np.searchsorted(ends_b, start, "right")
    beyond = np.iinfo(np.int64).max
    ends_a, ends_b = np.r_[ends_a, beyond], np.r_[ends_b, beyond]
    cuts_a, cuts_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(a):
        x, y = ends_a[a], ends_b[b]
        going = np.maximum(x, y) <= stop
        if not going.all():
            a, b, stop, x, y = a[going], b[going], stop[going], x[going], y[going]
        cut = x == y
        cuts_a.append(a[cut])
        cuts_b.append(b[cut])
        a, b = a + (x <= y), b + (y <= x)
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """Loaded once in each Python worker."""
    return Aligner(path_a, path_b)


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _packed(pairs: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Bytes of steps between pairs and of times, plane by plane."""
    both = np.concatenate([np.diff(pairs, prepend=0), times]).astype("<u4")
    return both.view(np.uint8).reshape(-1, 4).T


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: block, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links
    (packed); and per pair of a block: block, pair, n (documents of the block that link it)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        packer = zstandard.ZstdCompressor(level=1)
        block, size = TaskContext.get().partitionId() << 24, 0
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def told() -> Iterator[pa.RecordBatch]:
            pairs, times = _added(*(np.concatenate(x) for x in zip(*held)))
            for first in range(0, len(pairs), 1 << 16):
                part = slice(first, first + (1 << 16))
                yield _rows(block=np.full(len(pairs[part]), block), pair=pairs[part], n=times[part])

        for batch in text_slices(batches):
            found = both.align(batch.column("text").to_pylist())
            cuts = list(zip(found["bounds"].tolist(), found["bounds"][1:].tolist()))
            links = [
                packer.compress(_packed(found["pairs"][x:y], found["times"][x:y]).tobytes()) if y > x else None
                for x, y in cuts
            ]
            rows = {c: found[c] for c in (*_COUNTS, "groups_sha256")}
            yield _rows(doc_id=batch.column("doc_id"), block=np.full(batch.num_rows, block), links=links, **rows)
            once = np.ones(len(found["pairs"]), np.int64)
            held.append(_added(found["pairs"], once))
            waiting += len(held[-1][0])
            if waiting > HELD:
                held = [_added(*(np.concatenate(x) for x in zip(*held)))]
                waiting = 0
            size += pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
            if size > BLOCK:
                yield from told()
                held, waiting, size = [], 0, 0
                block += 1
        if held:
            yield from told()

    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return read.mapInArrow(made, ", ".join(f"{c} {kind}" for c, kind in _KINDS.items()))


_KINDS = {
    "block": "bigint", "doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint",
    "n_links": "bigint", "groups_sha256": "string", "links": "binary", "pair": "bigint", "n": "bigint",
}
_ARROW = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _rows(**columns) -> pa.RecordBatch:
    n = len(columns["block"])
    arrays = {c: columns.get(c) for c in _KINDS}
    return pa.RecordBatch.from_pydict(
        {
            c: pa.nulls(n, _ARROW[_KINDS[c]]) if x is None else x if isinstance(x, pa.Array) else pa.array(x, _ARROW[_KINDS[c]])
            for c, x in arrays.items()
        }
    )


def _scored(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Sums of the answers over the links of each document of a block."""
    unpacker = zstandard.ZstdDecompressor()
    pairs = answers.column("pair").to_numpy()
    order = np.argsort(pairs)
    pairs = pairs[order]
    counts = answers.column("count").to_numpy()[order]
    best = answers.column("best").to_numpy(zero_copy_only=False)[order].astype(bool)
    n_best, count_sum = [], []
    for links in docs.column("links"):
        data = links.as_py()
        if data is None:
            n_best.append(0)
            count_sum.append(0)
            continue
        held, times = _unpacked(unpacker.decompress(data))
        at = np.searchsorted(pairs, held)
        n_best.append(int(times[best[at]].sum()))
        count_sum.append(int((times * counts[at]).sum()))
    kept = docs.select(["doc_id", *_COUNTS])
    kept = kept.append_column("n_best", pa.array(n_best, pa.int64()))
    kept = kept.append_column("count_sum", pa.array(count_sum, pa.int64()))
    return kept.append_column("groups_sha256", docs.column("groups_sha256"))


class Alignment:
    """Two tokenizers' alignment over ``docs``; the tables that its results share."""

    def __init__(self, docs: DataFrame, path_a: str | None = None, path_b: str | None = None):
        path_a, path_b = path_a or default_tokenizer(), path_b or default_pieces()
        self.n_b = len(aligner(path_a, path_b).lengths_b)
        self.rows = store(aligned(docs, path_a, path_b), "aligned")

    def counts(self) -> DataFrame:
        """Each linked pair of ids: pair, a, b, count (documents), best (no pair of its A
        id has a higher count)."""
        told = self.rows.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("count"))
        told = told.select("pair", F.expr(f"pair div {self.n_b}").alias("a"), (F.col("pair") % self.n_b).alias("b"), "count")
        told = store(told, "pairs")
        highest = told.groupBy("a").agg(F.max("count").alias("highest"))
        joined = told.join(highest, "a")
        return joined.select("pair", "a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))

    def documents(self) -> DataFrame:
        """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
        docs = self.rows.where("pair is null").select("block", "doc_id", *_COUNTS, "groups_sha256", "links")
        asked = self.rows.where("pair is not null").select(F.col("block").alias("asker"), "pair")
        answers = asked.join(self.counts().select("pair", "count", "best"), "pair")
        schema = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in (*_COUNTS, "n_best", "count_sum")) + ", groups_sha256 string"
        return docs.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(_scored, schema)


def op12_alignment(spark, docs: DataFrame) -> DataFrame:
    return Alignment(docs).documents()
