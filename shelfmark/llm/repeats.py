"""Passages of 200 bytes or more that stand in several places, by a sparse suffix array.

Suffixes start at anchors: places whose ``GRAM`` bytes have the least hash of some
window of ``WINDOW`` bytes. A window's least gram depends on its bytes alone, so equal
windows hold an anchor at the same offset, and two windows are equal if and only if the
suffixes at their anchors agree to the right, and what precedes them agrees to the left,
far enough. Every window that repeats is found so, from about one suffix in 80 bytes.

Suffixes that share their first ``GRAM`` bytes are a section of the suffix array. Spark
deals the sections over tasks and sorts each; a task scans it once with a stack of
common-prefix intervals. An interval's members agree in so many bytes to the right; when
two intervals meet, each member of the smaller is placed among the larger's members in
the order of what precedes them. Its neighbours there are those that agree with it
furthest to the left; where left and right together reach ``WINDOW`` bytes, and since the
members differ beyond, the passage is a maximal repeat, and all members of the interval
that agree so far to the left are its occurrences.

Equal surroundings of an anchor (``WINDOW - GRAM`` bytes before it, ``WINDOW`` from it
on) are one member, whatever their number, counted by Spark before any text is moved.
Sections of more than ``SECTION`` different members are not given to one task: their
windows are counted by hash instead, which gives the same spans.

Texts are bytes of UTF-8; null is the empty text. Equal texts of ``WINDOW`` bytes or more
repeat whole, whatever their doc_id. No column but doc_id and text is read, every row is
returned once, and rows that repeat whole are texts that repeat.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import store

WINDOW = 200
#: Bytes that choose an anchor, and that the members of a section share.
GRAM = 40
#: Most bytes before an anchor in a window that holds its gram.
BEFORE = WINDOW - GRAM
#: Most different surroundings that one task compares.
SECTION = 32_768
#: Bytes that a task looks for anchors in at once.
PART = 1 << 20
#: Texts that a task remembers, to look at equal ones once.
REMEMBERED = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


class _Powers:
    """Powers of the base modulo 2**64, and of its inverse."""

    def __init__(self, n: int):
        inverse = pow(_BASE, -1, 1 << 64)
        self.up = np.cumprod(np.full(n, _BASE, np.uint64))
        self.down = np.cumprod(np.full(n, inverse, np.uint64))


def _sliding(x: np.ndarray, width: int, best: np.ufunc, worst: np.uint64) -> np.ndarray:
    """The best of each run of ``width`` values."""
    blocks = np.full(-(-len(x) // width) * width, worst, np.uint64)
    blocks[: len(x)] = x
    blocks = blocks.reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: len(x) - width + 1], ahead[width - 1 : len(x)])


def anchors(data: np.ndarray, ends: list[int], powers: _Powers) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors in ``data``, and the hashes of their grams. Texts end at
    ``ends`` and hold ``WINDOW`` bytes each, at least."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers.up[: len(data)], out=sums[1:])
    grams = (sums[GRAM:] - sums[:-GRAM]) * powers.down[: len(data) - GRAM + 1]
    grams = (grams ^ (grams >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    grams ^= grams >> np.uint64(29)
    for end in ends[:-1]:
        grams[end - GRAM + 1 : end] = _NONE
    least = _sliding(grams, BEFORE + 1, np.minimum, _NONE)
    for end in ends[:-1]:
        least[end - WINDOW + 1 : end] = 0
    around = np.zeros(len(least) + 2 * BEFORE, np.uint64)
    around[BEFORE : BEFORE + len(least)] = least
    chosen = (_sliding(around, BEFORE + 1, np.maximum, np.uint64(0)) == grams) & (grams != _NONE)
    places = np.flatnonzero(chosen)
    return places, grams[places]


def _parts(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int, list[int], int]]:
    """(first byte, last, ends of texts, first text) of runs of whole texts of about
    ``size`` bytes; a longer text comes in overlapping parts that hold all its windows."""
    first = 0
    while first < len(offsets) - 1:
        last = max(int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1, first + 1)
        start, end = int(offsets[first]), int(offsets[last])
        if end - start <= size:
            yield start, end, [int(e) - start for e in offsets[first + 1 : last + 1]], first
        else:
            for at in range(start, end - WINDOW + 1, size):
                stop = min(at + size + WINDOW - 1, end)
                yield at, stop, [stop - at], first
        first = last


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A binary column's bytes, and where its values begin and end in them."""
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def _anchor_rows(texts: DataFrame, whole: bool) -> DataFrame:
    """Per anchor of ``texts`` (text_a, text_b, data): the hash of its gram, key; with
    ``whole`` also ctx (hash of its surroundings), text_a, text_b and pos. A task looks at
    equal texts once."""
    size = PART

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers(size + WINDOW)
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            names = list(zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()))
            if len(seen) > REMEMBERED:
                seen.clear()
            new = []
            for name in names:
                new.append(name not in seen)
                seen.add(name)
            batch = batch.filter(pa.array(new, pa.bool_()))
            if not batch.num_rows:
                continue
            data, offsets = _binary(batch.column("data"))
            held = memoryview(data)
            names = [batch.column(c).to_numpy() for c in ("text_a", "text_b")]
            before, stop = np.zeros(0, np.int64), 0
            for start, end, ends, first in _parts(offsets, size):
                at, grams = anchors(data[start:end], ends, powers)
                if start < stop:
                    # Parts of a long text overlap: an anchor found in both is one anchor.
                    new = ~np.isin(at + start, before)
                    before, at, grams = at + start, at[new], grams[new]
                else:
                    before = at + start
                stop = end
                found = {"key": grams.view(np.int64)}
                if whole:
                    text = first + np.searchsorted(ends, at, "right")
                    at = at + start
                    left = np.maximum(offsets[text], at - BEFORE).tolist()
                    right = np.minimum(offsets[text + 1], at + WINDOW).tolist()
                    hashed = [
                        xxhash.xxh3_64_intdigest(held[a:b], seed=p - a) for a, p, b in zip(left, at.tolist(), right)
                    ]
                    found["ctx"] = np.array(hashed, np.uint64).view(np.int64)
                    found |= {c: x[text] for c, x in zip(("text_a", "text_b"), names)}
                    found["pos"] = (at - offsets[text]).astype(np.int32)
                yield pa.RecordBatch.from_pydict(found)

    schema = "key bigint" + ", ctx bigint, text_a bigint, text_b bigint, pos int" * whole
    return texts.select("text_a", "text_b", "data").mapInArrow(made, schema)


def _common(one: int, other: int, width: int, most: int) -> int:
    """Equal leading bytes of two numbers of ``width`` bytes, ``most`` at most."""
    unlike = one ^ other
    return min(most, width - (unlike.bit_length() + 7 >> 3)) if unlike else most


class _Interval:
    """Neighbours in the suffix array that agree in ``depth`` bytes: their ranks by what
    precedes them, and the pairs of its parts that repeat, as (bytes to the left, rank)."""

    def __init__(self, members: list[int], depth: int = -1, repeats: set[tuple[int, int]] | None = None):
        self.members, self.depth, self.repeats = members, depth, repeats or set()


def scan_section(
    rights: list[bytes], lefts: list[bytes], groups: list | None = None
) -> tuple[list[int], list[int]]:
    """For each member of a section, how far it repeats to the left and to the right.

    ``rights`` is sorted; ``lefts`` are reversed, from the anchor backwards. Both results
    are 0 where no passage of ``WINDOW`` bytes repeats. ``groups`` gets (left, right,
    members) of each maximal repeat, with all its occurrences.
    """
    n = len(rights)
    order = sorted(range(n), key=lefts.__getitem__)
    rank = [0] * n
    for place, i in enumerate(order):
        rank[i] = place
    before = [int.from_bytes(lefts[i].ljust(BEFORE, b"\0"), "big") for i in order]
    reach = [len(lefts[i]) for i in order]
    best_left, best_right = [0] * n, [0] * n

    def left_of(x: int, y: int) -> int:
        return _common(before[x], before[y], BEFORE, min(reach[x], reach[y]))

    def meets(one: _Interval, other: _Interval, right: int) -> _Interval:
        """Both intervals as one; pairs between them agree in ``right`` bytes."""
        small, large = sorted((one.members, other.members), key=len)
        repeats = set()
        for x in small:
            at = bisect_left(large, x)
            for y in large[max(at - 1, 0) : at + 1]:
                left = left_of(x, y)
                if left + right >= WINDOW:
                    repeats.add((left, x))
                    for z in (x, y):
                        best_left[z] = max(best_left[z], left)
                        best_right[z] = max(best_right[z], right)
        if groups is not None:
            for interval in (one, other):
                # An interval of the same depth goes on; a deeper one is whole.
                if interval.depth == right:
                    repeats |= interval.repeats
                else:
                    tell(interval)
        if len(small) * 8 < len(large):
            for x in small:
                insort(large, x)
        else:
            large = sorted(large + small)
        return _Interval(large, right, repeats)

    def tell(interval: _Interval) -> None:
        """The maximal repeats of a whole interval: the members around each pair that met,
        and those around them that agree less far, as long as it is far enough."""
        members, told = interval.members, set()
        for left, x in interval.repeats:
            first = last = bisect_left(members, x)
            while left + interval.depth >= WINDOW:
                while first and left_of(members[first - 1], x) >= left:
                    first -= 1
                while last + 1 < len(members) and left_of(members[last + 1], x) >= left:
                    last += 1
                if (first, last, left) in told:
                    break
                told.add((first, last, left))
                groups.append((left, interval.depth, [order[y] for y in members[first : last + 1]]))
                outside = [members[i] for i in (first - 1, last + 1) if 0 <= i < len(members)]
                left = max((left_of(y, x) for y in outside), default=-WINDOW)

    after = [int.from_bytes(x.ljust(WINDOW, b"\0"), "big") for x in rights]
    stack: list[tuple[int, _Interval]] = []
    last = _Interval([rank[0]])
    for i in range(1, n):
        depth = _common(after[i - 1], after[i], WINDOW, min(len(rights[i - 1]), len(rights[i])))
        while stack and stack[-1][0] >= depth:
            shared, interval = stack.pop()
            last = meets(interval, last, shared)
        stack.append((depth, last))
        last = _Interval([rank[i]])
    while stack:
        shared, interval = stack.pop()
        last = meets(interval, last, shared)
    if groups is not None:
        tell(last)
    return [best_left[r] for r in rank], [best_right[r] for r in rank]


def _sections(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """The rows of each key; they come sorted by key."""
    held: dict[str, list] = {}
    for batch in batches:
        keys = batch.column("key").to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        columns = batch.to_pydict()
        for first, last in zip(cuts, cuts[1:]):
            part = {c: x[first:last] for c, x in columns.items()}
            if held and held["key"][0] == part["key"][0]:
                for c, x in part.items():
                    held[c] += x
            else:
                if held:
                    yield held
                held = part
    if held and held["key"]:
        yield held


def _scanned(members: DataFrame) -> DataFrame:
    """(key, ctx, l, r) of the members (key, ctx, n, before, after) that repeat in part;
    those with n > 1 repeat whole."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {c: [] for c in ("key", "ctx", "l", "r")}
        for section in _sections(batches):
            left, right = scan_section(section["after"], section["before"])
            for key, ctx, n, a, b in zip(section["key"], section["ctx"], section["n"], left, right):
                if b and n == 1:
                    for c, x in zip(out, (key, ctx, a, b)):
                        out[c].append(x)
            if len(out["key"]) >= 10_000:
                yield pa.RecordBatch.from_pydict(out, _COVER)
                out = {c: [] for c in out}
        yield pa.RecordBatch.from_pydict(out, _COVER)

    dealt = members.repartition("key").sortWithinPartitions("key", "after")
    return dealt.mapInArrow(scan, "key bigint, ctx bigint, l int, r int")


_COVER = pa.schema([("key", pa.int64()), ("ctx", pa.int64()), ("l", pa.int32()), ("r", pa.int32())])


def _counted(members: DataFrame) -> DataFrame:
    """The same as :func:`_scanned`, by the hashes of all windows that hold the anchor:
    for sections that no task could hold. Counts are combined before they are shuffled."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                out: dict[str, list] = {c: [] for c in ("key", "ctx", "r", "hash")}
                for row in batch.slice(i, 256).to_pylist():
                    text = row["before"][::-1] + row["after"]
                    at = len(row["before"])
                    for start in range(0, min(at, len(text) - WINDOW) + 1):
                        out["key"].append(row["key"])
                        out["ctx"].append(row["ctx"])
                        out["r"].append(start + WINDOW - at)
                        hashed = xxhash.xxh3_64_intdigest(text[start : start + WINDOW])
                        out["hash"].append(hashed - (1 << 63))
                yield pa.RecordBatch.from_pydict(
                    {c: pa.array(x, pa.int32() if c == "r" else pa.int64()) for c, x in out.items()}
                )

    read = members.select("key", "ctx", "before", "after")
    rows = store(read.mapInArrow(windows, "key bigint, ctx bigint, r int, hash bigint"), "windows")
    again = rows.groupBy("key", "r", "hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = rows.join(again.select("key", "r", "hash"), ["key", "r", "hash"])
    left = F.max(F.lit(WINDOW) - F.col("r")).alias("l")
    return held.groupBy("key", "ctx").agg(left, F.max("r").alias("r"))


def _text_keys(data: Column) -> list[Column]:
    return [F.xxhash64(F.lit(1), data).alias("text_a"), F.xxhash64(F.lit(2), data).alias("text_b")]


def _bytes(docs: DataFrame) -> Column:
    return F.coalesce(F.col("text").cast("binary"), F.lit(b""))


def _merged(places: list[dict], length: int) -> list[tuple[int, int]]:
    """Covered runs (start, end) of a text, adjoining ones as one."""
    runs: list[tuple[int, int]] = []
    for start, end in sorted((max(0, p["pos"] - p["l"]), min(length, p["pos"] + p["r"])) for p in places):
        if runs and start <= runs[-1][1]:
            runs[-1] = runs[-1][0], max(end, runs[-1][1])
        else:
            runs.append((start, end))
    return runs


class Repeats:
    """What repeats in the texts of ``docs``; the tables that its results share."""

    def __init__(self, docs: DataFrame, section: int = SECTION):
        self.docs = docs
        data = _bytes(docs)
        self.texts = docs.select(data.alias("data")).where(F.octet_length("data") >= WINDOW)
        self.texts = self.texts.select("data", *_text_keys(F.col("data")))
        #: One row for each different text.
        self.distinct = self.texts.groupBy("text_a", "text_b").agg(
            F.first("data").alias("data"), F.count(F.lit(1)).alias("copies")
        )
        keys = _anchor_rows(self.texts, whole=False).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        live = _anchor_rows(self.texts, whole=True).join(keys.where("n > 1").select("key"), "key")
        #: Anchors whose gram stands in several places: key, ctx, text_a, text_b, pos.
        self.live = store(live, "anchors")
        found = self.live.groupBy("key", "ctx").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("text_a", "text_b", "pos")).alias("place")
        )
        members = found.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
        #: Different surroundings: key, ctx, n (occurrences), place of one, members of the key.
        self.surroundings = store(found.join(members, "key"), "surroundings")
        self.section = section

    def members(self, which: str) -> DataFrame:
        """key, ctx, n, before (reversed), after of the chosen surroundings."""
        asked = self.surroundings.where(which).select(
            "place.text_a", "place.text_b", F.struct("place.pos", "key", "ctx", "n").alias("asked")
        )
        asked = asked.groupBy("text_a", "text_b").agg(F.collect_list("asked").alias("asked"))
        # All columns, so that the texts are shuffled once for this and for spans().
        joined = self.distinct.where("copies > 0").join(asked, ["text_a", "text_b"]).select("data", "asked")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for data, asked in zip(batch.column("data"), batch.column("asked").to_pylist()):
                    text = data.as_py()
                    yield pa.RecordBatch.from_pydict(
                        {
                            "key": pa.array([x["key"] for x in asked], pa.int64()),
                            "ctx": pa.array([x["ctx"] for x in asked], pa.int64()),
                            "n": pa.array([x["n"] for x in asked], pa.int64()),
                            "before": [text[max(0, x["pos"] - BEFORE) : x["pos"]][::-1] for x in asked],
                            "after": [text[x["pos"] : x["pos"] + WINDOW] for x in asked],
                        }
                    )

        return joined.mapInArrow(cut, "key bigint, ctx bigint, n bigint, before binary, after binary")

    def covers(self) -> DataFrame:
        """(key, ctx, l, r): how far surroundings repeat to the left and the right."""
        whole = self.surroundings.where("n > 1").select(
            "key", "ctx", F.lit(BEFORE).alias("l"), F.lit(WINDOW).alias("r")
        )
        few = _scanned(self.members(f"members between 2 and {self.section}"))
        many = _counted(self.members(f"members > {self.section}"))
        return whole.union(few).union(many)

    def spans(self) -> DataFrame:
        """text_a, text_b, n_removed, n_spans, kept_sha256, spans (start, length) of the
        texts in which something repeats."""
        place = F.struct("pos", "l", "r")
        covered = self.live.join(self.covers(), ["key", "ctx"]).groupBy("text_a", "text_b").agg(
            F.collect_set(place).alias("places")
        )
        cut = self.distinct.where("copies = 1").join(covered, ["text_a", "text_b"])
        schema = "text_a bigint, text_b bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,length:bigint>>"
        parts = cut.select("text_a", "text_b", "data", "places").mapInArrow(_cut, schema)
        whole = self.texts.groupBy("text_a", "text_b").agg(
            F.count(F.lit(1)).alias("copies"), F.first(F.octet_length("data")).cast("bigint").alias("n_removed")
        )
        span = F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_removed").alias("length"))
        whole = whole.where("copies > 1").select(
            "text_a", "text_b", "n_removed", F.lit(1).cast("bigint").alias("n_spans"),
            F.lit(hashlib.sha256().hexdigest()).alias("kept_sha256"), F.array(span).alias("spans"),
        )
        return parts.union(whole)

    def documents(self) -> DataFrame:
        """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans."""
        data = _bytes(self.docs)
        rows = self.docs.select(
            "doc_id", F.octet_length(data).cast("bigint").alias("n_bytes"),
            F.sha2(data, 256).alias("whole_sha256"), *_text_keys(data),
        )
        none = F.lit(0).cast("bigint")
        return rows.join(self.spans(), ["text_a", "text_b"], "left").select(
            "doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"),
            F.coalesce("n_spans", none).alias("n_spans"),
            F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"), "spans",
        )

    def groups(self) -> DataFrame:
        """Maximal repeats with all their occurrences: repeat (hash of the passage),
        n_bytes, text_a, text_b, start; one row an occurrence in a different text.

        Passages are seen as far as the surroundings of an anchor go: a repeat longer than
        that comes as overlapping ones.
        """

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for section in _sections(batches):
                groups: list = []
                scan_section(section["after"], section["before"], groups)
                out: dict[str, list] = {c: [] for c in ("key", "ctx", "repeat", "l", "r")}
                for left, right, members in groups:
                    text = section["before"][members[0]][:left][::-1] + section["after"][members[0]][:right]
                    named = xxhash.xxh3_64_intdigest(text) - (1 << 63)
                    for i in members:
                        for c, x in zip(out, (section["key"][i], section["ctx"][i], named, left, right)):
                            out[c].append(x)
                yield pa.RecordBatch.from_pydict(
                    {c: pa.array(x, pa.int32() if c in ("l", "r") else pa.int64()) for c, x in out.items()}
                )

        dealt = self.members("members > 1").repartition("key").sortWithinPartitions("key", "after")
        found = dealt.mapInArrow(scan, "key bigint, ctx bigint, repeat bigint, l int, r int").distinct()
        start = (F.col("pos") - F.col("l")).alias("start")
        rows = found.join(self.live, ["key", "ctx"])
        return rows.select("repeat", (F.col("l") + F.col("r")).alias("n_bytes"), "text_a", "text_b", start).distinct()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {c: [] for c in ("n_removed", "n_spans", "kept_sha256", "spans")}
        for data, places in zip(batch.column("data"), batch.column("places").to_pylist()):
            text = memoryview(data.as_buffer())
            runs = _merged(places, len(text))
            kept, at = hashlib.sha256(), 0
            for start, end in runs:
                kept.update(text[at:start])
                at = end
            kept.update(text[at:])
            out["n_removed"].append(sum(end - start for start, end in runs))
            out["n_spans"].append(len(runs))
            out["kept_sha256"].append(kept.hexdigest())
            out["spans"].append([{"start": start, "length": end - start} for start, end in runs])
        kinds = {"n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "spans": _SPANS}
        yield pa.RecordBatch.from_pydict(
            {"text_a": batch.column("text_a"), "text_b": batch.column("text_b")}
            | {c: pa.array(x, kinds[c]) for c, x in out.items()}
        )


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


def op11_repeats(spark, docs: DataFrame) -> DataFrame:
    return Repeats(docs).documents().drop("spans")
