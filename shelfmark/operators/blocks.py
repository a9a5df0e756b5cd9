"""Top-k of a block of queries against batches of items, with numpy.

A batch is screened with one matrix product. Rounding of that product is
bounded, so the screen only drops items that cannot be among the k best; the
survivors are scored again with the direct formula in double, rounded to a fixed
number of places and ordered by (score, item id).
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

QUERY_TILE = 512
ITEM_TILE = 4096
#: Items whose products with a tile of queries are made at a time, to stay in a core's cache.
STRIP = 512
BATCH_QUERIES = 2048
RESCORE_VALUES = 1 << 21
#: Numbers of vectors that are fingerprinted at once.
PRINT_VALUES = 1 << 20
EMIT_ROWS = 50_000
#: Survivors per wanted result from which a query's whole tile is scored at once.
CROWDED = 16
NO_ITEM = np.iinfo(np.int64).max
METRICS = ("l2", "cosine")


def vectors_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column as a (rows, dim) float32 array; every row must be as long."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    if rows == 0:
        return np.zeros((0, 0), dtype=np.float32)
    if column.null_count:
        raise ValueError("null vector")
    values = column.flatten()
    dim, rest = divmod(len(values), rows)
    ends = np.asarray(column.offsets)
    if rest or values.null_count or not np.all(np.diff(ends) == dim):
        raise ValueError("vectors differ in length or hold nulls")
    return values.to_numpy(zero_copy_only=False).astype(np.float32, copy=False).reshape(rows, dim)


def placed(column: pa.Array, metric: str) -> np.ndarray:
    """Vectors as inverted lists see them: of length one for ``cosine``."""
    vectors = vectors_of(column)
    if metric != "cosine":
        return vectors
    lengths = lengths_of(vectors)[:, None]
    return (vectors / np.where(lengths > 0, lengths, 1)).astype(np.float32)


#: Odd multipliers of the row fingerprints; more are drawn for longer rows.
_MIX = np.random.default_rng(5).integers(0, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def same_vectors(vectors: np.ndarray) -> np.ndarray:
    """A number per row, counted from 0 in order of first sight; equal rows share one.

    Rows are told apart by a 64-bit fingerprint; only rows that share one are compared.
    """
    rows = np.ascontiguousarray(vectors)
    n, width = rows.shape
    if n == 0 or width == 0:
        return np.zeros(n, np.int64)
    mix = np.resize(_MIX, width) * (np.arange(width, dtype=np.uint64) // np.uint64(len(_MIX)) * np.uint64(2) + np.uint64(1))
    # A few rows at a time: wide copies of all would take several times their room.
    step = max(1, PRINT_VALUES // width)
    parts = [slice(start, start + step) for start in range(0, n, step)]
    prints = np.empty(n, np.uint64)
    for part in parts:
        words = (rows[part].view(f"u{rows.dtype.itemsize}").astype(np.uint64) + np.uint64(1)) * mix
        words ^= words >> np.uint64(29)
        words *= mix[::-1]
        prints[part] = words.sum(axis=1, dtype=np.uint64)
    _, first, label = np.unique(prints, return_index=True, return_inverse=True)
    if not all(np.array_equal(rows[first[label[part]]].view(np.uint8), rows[part].view(np.uint8)) for part in parts):
        # Two vectors share a fingerprint: compare whole rows.
        whole = rows.view(np.dtype((np.void, rows.dtype.itemsize * width))).ravel()
        _, first, label = np.unique(whole, return_index=True, return_inverse=True)
    order = np.argsort(np.argsort(first))
    return order[label].astype(np.int64)


def best_of_block(
    ids: np.ndarray, vectors: np.ndarray, items: tuple, k: int, metric: str, digits: int
) -> Iterator[pa.RecordBatch]:
    """The k best of one block of items, which :func:`prepared` laid out, for a batch of
    queries, equal queries compared once."""
    for start in range(0, len(ids), BATCH_QUERIES):
        asked, rows = ids[start : start + BATCH_QUERIES], vectors[start : start + BATCH_QUERIES]
        labels = same_vectors(rows)
        first = np.unique(labels, return_index=True)[1]
        best = TopK(asked[first], rows[first], k, metric, digits)
        best.add_prepared(*items)
        best.ids, best.cost, best.item = asked, best.cost[labels], best.item[labels]
        yield best.result()


def drop_far_copies(ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of items with the same vector keep the k smallest ids.

    Copies score alike and ties go to the smaller id, so the others cannot be
    among the k best of any query. This keeps large groups of copies cheap.
    """
    if len(ids) <= k:
        return ids, vectors
    labels = same_vectors(vectors)
    if labels.max() + 1 == len(ids):
        return ids, vectors
    order = np.lexsort((ids, labels))
    sorted_labels = labels[order]
    place = np.arange(len(order)) - np.searchsorted(sorted_labels, sorted_labels)
    kept = order[place < k]
    return ids[kept], vectors[kept]


def prepared(ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, vectors and lengths of items as :meth:`TopK.add_prepared` takes them: copies
    that cannot be among the k best left out, in order of the ids."""
    ids, vectors = drop_far_copies(ids, vectors, k)
    order = np.argsort(ids)  # so that among equals of a tile the first has the smallest id
    ids, vectors = ids[order], vectors[order]
    return ids, vectors, lengths_of(vectors)


class _Scratch(threading.local):
    """Room for the products of a strip and what they reach, used again for the next:
    fresh pages for each would take about as long as filling them."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def room(self, name: str, shape: tuple[int, int], kind: type) -> np.ndarray:
        size = shape[0] * shape[1]
        held = self.held.get(name)
        if held is None or held.dtype != kind or held.size < size:
            held = self.held[name] = np.empty(size, kind)
        return held[:size].reshape(shape)


_scratch = _Scratch()


def screened(left: np.ndarray, right: np.ndarray, least: np.ndarray, name: str) -> np.ndarray:
    """Which products of a row of ``left`` and one of ``right`` reach ``least`` of the
    former. They stand in room that the next call under ``name`` takes again."""
    kind = left.dtype.type
    near = _scratch.room(name, (len(left), len(right)), np.bool_)
    with np.errstate(invalid="ignore", over="ignore"):
        # Rounded down, so that nothing is lost to fewer bits.
        floor = np.nextafter(least.astype(kind), kind(-np.inf))[:, None]
        for start in range(0, len(right), STRIP):
            part = right[start : start + STRIP]
            products = np.matmul(left, part.T, out=_scratch.room("products", (len(left), len(part)), kind))
            np.greater_equal(products, floor, out=near[:, start : start + STRIP])
    return near


def chosen(near: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and columns of what is true in ``near``, but for the rows that have more than
    ``most``, which come third."""
    width = near.shape[1]
    if np.count_nonzero(near) * 64 > near.size:
        counts = near.sum(axis=1)
        crowded = np.flatnonzero(counts > most)
        near[crowded] = False
        row, col = np.divmod(np.flatnonzero(near), width)
        return row, col, crowded
    row, col = np.divmod(np.flatnonzero(near), width)
    counts = np.bincount(row, minlength=len(near))
    crowded = np.flatnonzero(counts > most)
    if len(crowded):
        few = counts[row] <= most
        row, col = row[few], col[few]
    return row, col, crowded


@dataclass(frozen=True)
class Tile:
    """Items laid out for the screen: the rows of ``right`` times those of the queries."""

    ids: np.ndarray
    vectors: np.ndarray
    lengths: np.ndarray
    right: np.ndarray


class TopK:
    """The k best items seen so far for each query of a block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, metric: str, digits: int):
        if metric not in METRICS:
            raise ValueError(f"metric must be one of {METRICS}")
        self.ids, self.vectors, self.k = ids, vectors, k
        self.metric, self.digits = metric, digits
        self.cost = np.full((len(ids), k), np.inf)
        self.item = np.full((len(ids), k), NO_ITEM, dtype=np.int64)
        self.lengths = lengths_of(vectors)
        self.longest = self.lengths.max(initial=0.0)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        if len(ids) and len(self.ids):
            self.add_prepared(*prepared(ids, vectors, self.k))

    def add_prepared(self, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray) -> None:
        """:meth:`add` of items that were laid out for this k, once for many blocks."""
        if len(ids) == 0 or len(self.ids) == 0:
            return
        if vectors.shape[1] != self.vectors.shape[1]:
            raise ValueError(
                f"query vectors have {self.vectors.shape[1]} dimensions, items {vectors.shape[1]}"
            )
        for i in range(0, len(ids), ITEM_TILE):
            part = slice(i, i + ITEM_TILE)
            tile = self._laid(ids[part], vectors[part], lengths[part])
            for q in range(0, len(self.ids), QUERY_TILE):
                self._tile(np.arange(q, min(q + QUERY_TILE, len(self.ids))), tile)

    def _laid(self, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray) -> Tile:
        kind = kind_for(self.longest, lengths.max(initial=0.0))
        if self.metric == "cosine":
            with np.errstate(divide="ignore", invalid="ignore"):
                return Tile(ids, vectors, lengths, (vectors / lengths[:, None]).astype(kind))
        # Half an item's square comes with the product, as one more dimension.
        right = np.empty((len(ids), vectors.shape[1] + 1), kind)
        right[:, :-1] = vectors
        right[:, -1] = lengths**2 * (unit_of(vectors.shape[1], kind) - 0.5)
        return Tile(ids, vectors, lengths, right)

    def _tile(self, rows: np.ndarray, tile: Tile, open_: np.ndarray | None = None) -> None:
        """Queries ``rows`` against a tile; with ``open_`` (rows, items) only what it allows."""
        kind, dim = tile.right.dtype.type, self.vectors.shape[1]
        unit = unit_of(dim, kind)
        q, q_len = self.vectors[rows], self.lengths[rows]
        if self.metric == "cosine":
            with np.errstate(divide="ignore", invalid="ignore"):
                left = (q / q_len[:, None]).astype(kind)
        else:
            left = np.ones((len(rows), dim + 1), kind)
            left[:, :dim] = q
        limit = self.cost[rows, -1]
        fresh = np.flatnonzero(~np.isfinite(limit))
        if len(fresh) and len(tile.ids) >= self.k:
            # No k items are known yet: the k best of this tile bound the cost.
            with np.errstate(invalid="ignore", over="ignore"):
                low = -(left[fresh] @ tile.right.T)
            if open_ is not None:
                low[~open_[fresh]] = np.inf
            best = np.argpartition(low, self.k - 1, axis=1)[:, : self.k]
            high = np.take_along_axis(low, best, axis=1).astype(np.float64)
            if self.metric == "cosine":
                high += 2 * unit
            else:
                size = q_len[fresh, None] ** 2
                high = size * (1 - 2 * unit) + 2 * high + 4 * unit * (size + tile.lengths[best] ** 2)
            limit[fresh] = np.fmin(limit[fresh], high.max(axis=1))
        near = screened(left, tile.right, self._least(limit, q_len, unit), "items")
        if open_ is not None:
            near &= open_
        row, col, crowded = chosen(near, CROWDED * self.k)
        if len(row):
            cost = self._rescore(rows[row], tile.vectors, tile.lengths, col)
            self._merge(rows[row], cost, tile.ids[col])
        if len(crowded):
            row, col, cost = self._best_of_crowd(
                rows[crowded], tile.vectors, tile.lengths, None if open_ is None else open_[crowded]
            )
            self._merge(row, cost, tile.ids[col])

    def _least(self, limit: np.ndarray, q_len: np.ndarray, unit: float) -> np.ndarray:
        """The least product of an item that may cost ``limit`` at most, rounding included."""
        limit = limit + 10.0**-self.digits
        return -limit - 2 * unit if self.metric == "cosine" else (q_len**2 * (1 - 2 * unit) - limit) / 2

    def _rescore(self, row: np.ndarray, vectors, lengths, col) -> np.ndarray:
        cost = np.empty(len(row))
        step = max(1, RESCORE_VALUES // vectors.shape[1])
        for s in range(0, len(row), step):
            r, c = row[s : s + step], col[s : s + step]
            a, b = self.vectors[r].astype(np.float64), vectors[c].astype(np.float64)
            if self.metric == "cosine":
                score = np.einsum("nd,nd->n", a, b) / (self.lengths[r] * lengths[c])
                cost[s : s + step] = -self._rounded(score)
            else:
                a -= b
                cost[s : s + step] = self._rounded(np.einsum("nd,nd->n", a, a))
        return cost

    def _best_of_crowd(self, rows, vectors, lengths, open_):
        """The k best of a tile for queries that many items tie on, such as a query
        without any word, which is as far from every item.

        One product in double gives all scores. Only a score whose error could
        carry it over a rounding edge is worked out again by the direct formula.
        """
        q, q_len = self.vectors[rows].astype(np.float64), self.lengths[rows]
        score = q @ vectors.astype(np.float64).T
        unit = 4 * (q.shape[1] + 16) * np.finfo(np.float64).eps
        if self.metric == "cosine":
            with np.errstate(divide="ignore", invalid="ignore"):
                score /= q_len[:, None] * lengths[None, :]
            error = unit
        else:
            size = q_len[:, None] ** 2 + lengths[None, :] ** 2
            score = size - 2 * score
            error = unit * size
        scaled = score * 10.0**self.digits + (0.5 + 1e-4)
        unsure = np.abs(scaled - np.rint(scaled)) <= error * 10.0**self.digits + 1e-6
        cost = self._rounded(score)
        if self.metric == "cosine":
            cost = -cost
        at, col = np.nonzero(unsure)
        cost[at, col] = self._rescore(rows[at], vectors, lengths, col)
        cost[np.isnan(cost)] = np.inf
        if open_ is not None:
            cost[~open_] = np.inf
        pick = cost <= self.cost[rows, -1][:, None]
        if cost.shape[1] > self.k:
            last = np.partition(cost, self.k - 1, axis=1)[:, self.k - 1 : self.k]
            equal = cost == last
            room = self.k - (cost < last).sum(axis=1, keepdims=True)
            pick &= (cost < last) | (equal & (np.cumsum(equal, axis=1) <= room))
        at, col = np.nonzero(pick & np.isfinite(cost))
        return rows[at], col, cost[at, col]

    def _rounded(self, score: np.ndarray) -> np.ndarray:
        return rounded(score, self.digits)

    def _merge(self, row, cost, item) -> None:
        touched, row = np.unique(row, return_inverse=True)
        held_cost, held_item = self.cost[touched], self.item[touched]
        held = np.isfinite(held_cost)
        row = np.concatenate([np.nonzero(held)[0], row])
        cost = np.concatenate([held_cost[held], cost])
        item = np.concatenate([held_item[held], item])
        row, place, order = first_of(row, cost, item, self.k)
        self.cost[touched[row], place] = cost[order]
        self.item[touched[row], place] = item[order]

    def results(self) -> Iterator[pa.RecordBatch]:
        """:meth:`result` in parts."""
        found = self.result()
        for start in range(0, found.num_rows, EMIT_ROWS):
            yield found.slice(start, EMIT_ROWS)

    def result(self) -> pa.RecordBatch:
        """Rows of (query_id, item_id, rank, score), best first."""
        row, col = np.nonzero(np.isfinite(self.cost))
        cost = self.cost[row, col]
        score = -cost if self.metric == "cosine" else cost
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.ids[row], pa.int64()),
                pa.array(self.item[row, col], pa.int64()),
                pa.array(col + 1, pa.int64()),
                pa.array(score + 0.0, pa.float64()),
            ],
            names=["query_id", "item_id", "rank", "score"],
        )


def first_of(row: np.ndarray, cost: np.ndarray, item: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k first of each row by (cost, item): their rows, places from 0, and where they are."""
    order = np.lexsort((item, cost, row))
    row = row[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    first = place < k
    return row[first], place[first], order[first]


def kind_for(*lengths: float) -> type:
    """32 bits, if squares of such lengths stay within them."""
    return np.float32 if all(length < 1e15 for length in lengths) else np.float64


def unit_of(dim: int, kind: type) -> float:
    """Bound on the rounding of a product of ``dim`` dimensions, relative to its lengths."""
    return (dim + 16) * float(np.finfo(kind).eps)


def rounded(score: np.ndarray, digits: int) -> np.ndarray:
    """Half up, with halves that fell short by rounding error counted as halves."""
    scale = 10.0**digits
    return np.floor(score * scale + (0.5 + 1e-4)) / scale


def lengths_of(vectors: np.ndarray) -> np.ndarray:
    found = np.empty(len(vectors))
    for first in range(0, len(vectors), ITEM_TILE):  # the wide copy stays small
        wide = vectors[first : first + ITEM_TILE].astype(np.float64)
        found[first : first + ITEM_TILE] = np.einsum("nd,nd->n", wide, wide)
    return np.sqrt(found)
