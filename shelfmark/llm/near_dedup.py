"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document's set is its distinct word pairs. Its signature, ``TREES * STEP`` minimum
hashes, is read in several orders, each starting ``STEP`` values further on; sorting
the signatures in one of these orders is a tree of the forest, and documents with a
long common prefix are its neighbours. A region of a tree is what shares a prefix.
Its depth adapts to how crowded it is: up to ``CROWD`` sets, all of them are
candidates for each other; beyond, each is a candidate for the region's first set and
the region is split by a longer prefix. At full depth each set is a candidate for the
first one of about its size. That gives a crowd its first links only: see Crowds.

Equal sets are one set from the start. Candidates are confirmed on the full sets, in
rounds: each set tries the partners that most trees agree on, and pairs that are
connected meanwhile need no check. A round tries many times as many as the one before,
until no candidate is left, so none is dropped and a group of thousands costs about
one check a member.

Two sets of similarity s share a region at the first depth in one tree with
probability ``s ** STEP``: at 0.8, 20 trees miss 3 pairs in 10,000. Deeper regions
are more selective, but hold more partners.

Crowds. What the candidates have not connected in a region of the first depth is
compared whole: its members are dealt into blocks by their group so far, and every
block meets every other, except blocks of one group. A meeting compares signatures, a
byte of each of their values, and names the members of which ``MATCHES`` bytes agree
with one of another group; of two sets of similarity 0.8 in a region, 3 in 10 million
fall short of that. The texts of these members then meet: all their intersections are
counted at once, and a spanning forest of the links found goes on, so a meeting returns
fewer links than it has members, and each is compared once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import store, text_slices
from shelfmark.llm.components import components
from shelfmark.session import share

TREES = 20
STEP = 5
#: Prefix lengths at which regions are formed.
DEPTHS = (5, 8, 12, 16)
#: Most sets of a region that are all compared.
CROWD = 12
#: Most members of a crowd in a block, and least equal bytes of their signatures.
BLOCK = 1024
MATCHES = 60
SIMILAR_PERCENT = 80
SHINGLE = 2
#: Bits that tell which texts the confirmation asks for; a power of two.
MARKS = 1 << 26

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Texts to sorted arrays of 64-bit shingle hashes."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def shingles(self, text: str | None) -> np.ndarray:
        """Lower-case A-Z, words without white space, distinct pairs of neighbours. One
        word is a set of itself; no words, or null, the empty set."""
        words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > 400_000:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if len(words) < SHINGLE:
            return _mixed(hashes)
        return np.unique(_mixed(_mixed(hashes[:-1]) + hashes[1:]))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD
    return x ^ (x >> np.uint64(29))


def _hash_functions() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(11)
    multipliers = random.integers(0, 1 << 63, TREES * STEP, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return multipliers, random.integers(0, 1 << 63, TREES * STEP, dtype=np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minimum of each hash function over each set (none of them empty)."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    columns = [
        np.minimum.reduceat((flat * a + b) >> np.uint64(32), starts) for a, b in zip(*_hash_functions())
    ]
    return np.stack(columns, axis=1)


def prefix_keys(signature: np.ndarray) -> np.ndarray:
    """(n, TREES, len(DEPTHS)) hashes of each order's prefixes, the tree included."""
    n, width = signature.shape
    order = (STEP * np.arange(TREES)[:, None] + np.arange(max(DEPTHS))) % width
    key = np.broadcast_to(np.arange(1, TREES + 1, dtype=np.uint64) * _ODD, (n, TREES))
    found = []
    for depth in range(max(DEPTHS)):
        key = _mixed(key + signature[:, order[:, depth]] + np.uint64(1))
        if depth + 1 in DEPTHS:
            found.append(key)
    return np.stack(found, axis=2)


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b, keys (prefix hashes, tree by tree) and marks (a
    byte of each value of the signature)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in text_slices(batches):
            sets = [shingler.shingles(t) for t in batch.column("text").to_pylist()]
            full = [s for s in sets if len(s)]
            signed = signatures(full) if full else np.zeros((0, TREES * STEP), np.uint64)
            keys = prefix_keys(signed).reshape(len(full), -1).view(np.int64) if full else []
            by_set, by_mark = iter(keys), iter(signed.astype(np.uint8))
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "set_a": pair[:, 0],
                    "set_b": pair[:, 1],
                    "keys": pa.array([next(by_set) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    "marks": pa.array([next(by_mark).tobytes() if len(s) else None for s in sets], pa.binary()),
                }
            )

    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, keys array<bigint>, marks binary"
    return read.mapInArrow(made, schema)


def _sizes_allow(n: Column, other: Column) -> Column:
    """The smaller set is at most the intersection, the larger at least the union."""
    return F.least(n, other) * 100 >= F.greatest(n, other) * SIMILAR_PERCENT


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def candidates(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a < b) of ``sets`` (id, n, keys) and the number of regions they share; and
    the crowds (region, id, n) that these pairs do not exhaust."""
    levels = range(len(DEPTHS))
    at = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    live = sets.select("id", "n", "keys", at).select(
        "id", "n", *(F.get("keys", F.col("tree") * len(DEPTHS) + i).alias(f"k{i}") for i in levels)
    )
    found = []
    for level in levels:
        key = f"k{level}"
        regions = live.groupBy(key).agg(
            F.count(F.lit(1)).alias("held"), F.min(F.struct("id", "n")).alias("head")
        )
        shared = store(live.join(regions.where("held > 1"), key), "regions")
        small = shared.where(F.col("held") <= CROWD).groupBy(key).agg(
            F.collect_list(F.struct("id", "n")).alias("members")
        )
        small = small.select("members", F.explode("members").alias("x"))
        partners = F.filter(
            "members", lambda y: (y["id"] > F.col("x.id")) & _sizes_allow(y["n"], F.col("x.n"))
        )
        small = small.select(F.col("x.id").alias("a"), F.explode(partners).alias("y"))
        found.append(small.select("a", F.col("y.id").alias("b")))
        crowded = shared.where((F.col("held") > CROWD))
        to_head = crowded.where((F.col("head.id") != F.col("id")) & _sizes_allow(F.col("n"), F.col("head.n")))
        found.append(to_head.select(*_ordered(F.col("head.id"), F.col("id"))))
        live = crowded.drop("held", "head")
        if level == 0:
            crowds = live.select(F.col(key).alias("region"), "id", "n")
    # At full depth each set is a candidate for the first one of about its size.
    alike = live.withColumn("size", F.floor(F.log("n") * 20))
    heads = alike.groupBy(key, "size").agg(F.min(F.struct("id", "n")).alias("head"))
    beside = alike.join(heads, [key, "size"]).where("head.id <> id")
    beside = beside.where(_sizes_allow(F.col("n"), F.col("head.n")))
    found.append(beside.select(*_ordered(F.col("head.id"), F.col("id"))))
    pairs = reduce(DataFrame.union, found)
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("votes")), crowds


def _meetings(crowds: DataFrame) -> DataFrame:
    """Members of ``crowds`` (region, id, n, component) that hold several components,
    once for each meeting of two blocks (u, v) that they take part in, with the side: 0
    or 1; 0 alone where a block meets itself.

    A component with more than half a block has blocks of its own, which need not meet
    each other; the others share blocks.
    """
    cells = store(crowds.groupBy("region", "component").agg(F.count(F.lit(1)).alias("held")), "cells")
    own = F.col("held") > BLOCK // 2
    plans = cells.groupBy("region").agg(
        F.count(F.lit(1)).alias("components"),
        F.ceil(F.coalesce(F.sum(F.when(~own, F.col("held"))), F.lit(0)) / (BLOCK // 2)).alias("shared"),
        F.collect_list(F.when(own, F.struct("component", "held"))).alias("owners"),
    )
    plans = plans.where("components > 1")

    def block(owned: Column, component: Column, part: Column) -> Column:
        return F.struct(
            owned.alias("owned"), component.cast("bigint").alias("component"), part.cast("bigint").alias("part")
        )

    def numbered(n: Column, made) -> Column:
        return F.transform(F.filter(F.sequence(F.lit(0).cast("bigint"), n), lambda i: i < n), made)

    def owned_blocks(x: Column) -> Column:
        return numbered(F.ceil(x["held"] / BLOCK), lambda i: block(F.lit(True), x["component"], i))

    blocks = F.concat(
        numbered(F.col("shared"), lambda i: block(F.lit(False), F.lit(0), i)),
        F.flatten(F.transform("owners", owned_blocks)),
    )
    plans = plans.select("region", "shared", blocks.alias("blocks"))
    firsts = plans.select("region", "blocks", F.posexplode("blocks").alias("at", "u"))
    met = F.filter(
        F.slice("blocks", F.col("at") + 1, F.size("blocks")),
        lambda v: ~(F.col("u.owned") & v["owned"] & (F.col("u.component") == v["component"])),
    )
    met = firsts.select("region", "u", F.explode(met).alias("v"))
    sides = F.when(F.col("u") == F.col("v"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    met = met.select("region", "u", "v", F.explode(sides).alias("side"))
    met = met.select("*", F.when(F.col("side") == 0, F.col("u")).otherwise(F.col("v")).alias("block"))
    placed = crowds.join(plans.select("region", "shared"), "region").join(cells, ["region", "component"])
    spread = F.pmod(F.xxhash64("id"), F.ceil(F.col("held") / BLOCK))
    dealt = F.pmod(F.xxhash64("component"), F.greatest(F.col("shared"), F.lit(1)))
    at = F.when(own, block(F.lit(True), F.col("component"), spread)).otherwise(
        block(F.lit(False), F.lit(0), dealt)
    )
    placed = placed.select("region", "id", "n", "component", at.alias("block"))
    return placed.join(met, ["region", "block"]).drop("block")


def _sides(table: pa.Table) -> tuple[pa.Table, pa.Table, bool]:
    """The two blocks of a meeting; a block that meets itself is both."""
    sides = table.column("side").to_numpy()
    left = table.filter(pa.array(sides == 0))
    if not (sides == 1).any():
        return left, left, True
    return left, table.filter(pa.array(sides == 1)), False


def _open(left: pa.Table, right: pa.Table) -> np.ndarray:
    """Pairs of different components whose sizes allow a link."""
    (n, m), (ours, theirs) = (
        [side.column(c).to_numpy() for side in (left, right)] for c in ("n", "component")
    )
    smaller, larger = np.minimum.outer(n, m), np.maximum.outer(n, m)
    return (ours[:, None] != theirs[None, :]) & (smaller * 100 >= larger * SIMILAR_PERCENT)


def name_candidates(table: pa.Table) -> pa.Table:
    """The members of a meeting that agree with one of another component in ``MATCHES``
    values of the signature: meeting, side, id, n, component."""
    left, right, itself = _sides(table)
    chosen_left, chosen_right = np.zeros(len(left), bool), np.zeros(len(right), bool)
    if len(left) and len(right):
        pairs = _open(left, right)
        ours, theirs = (
            np.ascontiguousarray(np.frombuffer(b"".join(side.column("marks").to_pylist()), np.uint8).reshape(-1, TREES * STEP).T)
            for side in (left, right)
        )
        for first in range(0, len(left), 128):
            matches = np.zeros((len(left.slice(first, 128)), len(right)), np.uint8)
            for one, other in zip(ours, theirs):
                matches += one[first : first + 128, None] == other[None, :]
            near = (matches >= MATCHES) & pairs[first : first + 128]
            chosen_left[first : first + 128] = near.any(axis=1)
            chosen_right |= near.any(axis=0)
    named = left.filter(pa.array(chosen_left))
    if not itself:
        named = pa.concat_tables([named, right.filter(pa.array(chosen_right))])
    return named.select(["meeting", "side", "id", "n", "component"])


#: Sets that hold a shingle, from which on it is counted by a matrix product.
COMMON = 16


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of all sets of ``left`` with all of ``right``, or with
    each other.

    Shingles that the same sets hold are one column that counts for all of them: what
    most members share costs little, however long it is. Columns of many sets are
    multiplied, those of few are added up pair by pair.
    """
    sets = left + (right or [])
    n = len(left)
    # Where the other side's members begin.
    other_from = n if right else 0
    m = len(sets) - other_from
    found = np.zeros((n, m), np.float32)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, member = flat[order], np.repeat(np.arange(len(sets)), [len(x) for x in sets])[order]
    starts = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    held = np.diff(np.r_[starts, len(flat)])
    starts, held = starts[held > 1], held[held > 1]
    if not len(starts):
        return found.astype(np.int64)
    at = np.repeat(starts - (np.cumsum(held) - held), held) + np.arange(held.sum())
    member, column = member[at], np.repeat(np.arange(len(starts)), held)
    draws = np.random.default_rng(5).integers(0, 1 << 63, (len(sets), 2), dtype=np.uint64)
    names = np.stack([np.add.reduceat(draws[member, i], np.cumsum(held) - held) for i in (0, 1)], axis=1)
    _, first, which, times = np.unique(names, axis=0, return_index=True, return_inverse=True, return_counts=True)
    kept = np.zeros(len(starts), bool)
    kept[first] = True
    weight = times[which.ravel()].astype(np.float32)
    common = held >= COMMON
    for columns, multiplied in ((kept & common, True), (kept & ~common, False)):
        number = np.cumsum(columns) - 1
        rows = columns[column]
        of, who, weights = number[column[rows]], member[rows], weight[columns]
        one, other = who < n, who >= other_from
        (i, of_i), (j, of_j) = (who[one], of[one]), (who[other] - other_from, of[other])
        if multiplied:
            for start in range(0, len(weights), 4096):
                width = min(4096, len(weights) - start)
                sides = []
                for size, places, at in ((n, i, of_i), (m, j, of_j)):
                    here = (at >= start) & (at < start + width)
                    side = np.zeros((size, width), np.float32)
                    side[places[here], at[here] - start] = 1
                    sides.append(side)
                found += (sides[0] * weights[start : start + width]) @ sides[1].T
        elif len(weights):
            others = np.bincount(of_j, minlength=len(weights))
            repeated = others[of_i]
            nth = np.arange(repeated.sum()) - np.repeat(np.cumsum(repeated) - repeated, repeated)
            met = j[np.repeat((np.cumsum(others) - others)[of_i], repeated) + nth]
            np.add.at(found, (np.repeat(i, repeated), met), np.repeat(weights[of_i], repeated))
    return np.rint(found).astype(np.int64)


def spanning_forest(linked: np.ndarray, itself: bool) -> list[tuple[int, int]]:
    """Links that connect all that ``linked`` connects, fewer than there are members."""
    n = len(linked)
    seen = np.zeros(n if itself else n + linked.shape[1], bool)
    links = []
    for first in np.flatnonzero(linked.any(axis=1)).tolist():
        if seen[first]:
            continue
        seen[first] = True
        waiting = [first]
        while waiting:
            i = waiting.pop()
            if itself:
                new = np.flatnonzero(linked[i] & ~seen)
            elif i < n:
                new = np.flatnonzero(linked[i] & ~seen[n:]) + n
            else:
                new = np.flatnonzero(linked[:, i - n] & ~seen[:n])
            seen[new] = True
            waiting += new.tolist()
            links += [(i, j) if itself or i < n else (j, i) for j in new.tolist()]
    return links if itself else [(i, j - n) for i, j in links]


def confirm_meeting(table: pa.Table) -> pa.Table:
    """Links of a meeting's members by their full sets, as a spanning forest: a, b, of_a,
    of_b (their components)."""
    left, right, itself = _sides(table)
    found = []
    if len(left) and len(right):
        shingler, unpacker = Shingler(), zstandard.ZstdDecompressor()
        ours, theirs = (
            [shingler.shingles(unpacker.decompress(x).decode()) for x in side.column("packed").to_pylist()]
            for side in (left, right)
        )
        both = overlaps(ours, None if itself else theirs)
        either = left.column("n").to_numpy()[:, None] + right.column("n").to_numpy()[None, :] - both
        linked = _open(left, right) & (both * 100 >= SIMILAR_PERCENT * either)
        found = spanning_forest(linked, itself)
    one, other = (np.array([x[i] for x in found], np.int64) for i in (0, 1))
    return pa.table(
        {
            "a": left.column("id").to_numpy()[one], "b": right.column("id").to_numpy()[other],
            "of_a": left.column("component").to_numpy()[one], "of_b": right.column("component").to_numpy()[other],
        }
    )


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; ``texts`` is (id, packed)."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, unpacker = Shingler(), zstandard.ZstdDecompressor()
        held: tuple[int | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for batch in batches:
            keep = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("b", "one", "other")))
            for b, one, other in rows:
                if held[0] != b:
                    held = b, shingler.shingles(unpacker.decompress(other).decode())
                left = shingler.shingles(unpacker.decompress(one).decode())
                both = len(np.intersect1d(left, held[1], assume_unique=True))
                keep.append(both * 100 >= SIMILAR_PERCENT * (len(left) + len(held[1]) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = texts.select(F.col("id").alias("a"), F.col("packed").alias("one"))
    other = texts.select(F.col("id").alias("b"), F.col("packed").alias("other"))
    joined = pairs.select("a", "b").join(one, "a").join(other, "b").select("a", "b", "one", "other")
    return joined.mapInArrow(check, "a bigint, b bigint")


def _marks(ids: DataFrame) -> np.ndarray:
    """A bit for each of the ids' low bits: at most MARKS / 8 bytes, however many ids."""
    bit = F.pmod("id", F.lit(MARKS))
    rows = ids.groupBy(F.shiftright(bit, 15).alias("block")).agg(
        F.bitmap_construct_agg(bit.bitwiseAND(F.lit(32767))).alias("bits")
    )
    marks = np.zeros((MARKS >> 15, 4096), np.uint8)
    for row in rows.collect():
        marks[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return marks.ravel()


def _packed(docs: DataFrame, marks: np.ndarray) -> DataFrame:
    """(id, packed) of the documents whose mark is set: all that are asked for, and
    others that share their low bits."""
    shared = share(docs.sparkSession, marks)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            at = batch.column("id").to_numpy() & (MARKS - 1)
            asked = batch.filter(pa.array((shared.value[at >> 3] >> (at & 7) & 1).astype(bool)))
            for part in text_slices(iter([asked])):
                packed = [packer.compress((t or "").encode()) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict({"id": part.column("id"), "packed": pa.array(packed, pa.binary())})

    read = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").where("id is not null")
    return read.mapInArrow(pack, "id bigint, packed binary")


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (id, component) once the components that ``links`` (of_a, of_b)
    connect are one."""
    groups = components(links.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))
    groups = groups.select(F.col("id").alias("component"), F.col("component").alias("to"))
    joined = labels.join(groups, "component", "left")
    return store(joined.select("id", F.coalesce("to", "component").alias("component")), "labels")


def linked_groups(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, component) of the ids of ``sets`` that are linked to another one."""
    found, crowds = candidates(sets)
    left = store(found, "candidates")
    ids = left.select(F.col("a").alias("id")).union(left.select(F.col("b").alias("id")))
    ids = store(ids.union(crowds.select("id")).distinct(), "ids")
    texts = store(_packed(docs, _marks(ids)).join(ids, "id", "left_semi"), "texts")
    labels = ids.select("id", F.col("id").alias("component"))
    tries = 1
    while True:
        a = labels.select(F.col("id").alias("a"), F.col("component").alias("of_a"))
        b = labels.select(F.col("id").alias("b"), F.col("component").alias("of_b"))
        open_pairs = left.join(a, "a").join(b, "b").where("of_a <> of_b")
        rank = F.row_number().over(Window.partitionBy("b").orderBy(F.col("votes").desc(), "a"))
        left = store(open_pairs.select("a", "b", "votes", "of_a", "of_b", rank.alias("rank")), "candidates")
        if left.isEmpty():
            break
        links = confirm(left.where(F.col("rank") <= tries), texts)
        labels = _joined(labels, links.join(left.select("a", "b", "of_a", "of_b"), ["a", "b"]))
        left = left.where(F.col("rank") > tries).select("a", "b", "votes")
        tries *= 16
    return crowd_groups(crowds, sets.select("id", "marks"), texts, labels)


def crowd_groups(crowds: DataFrame, marks: DataFrame, texts: DataFrame, labels: DataFrame) -> DataFrame:
    """``labels`` once all similar pairs of ``crowds`` (region, id, n) are linked.

    A meeting first names the members that have a candidate, then gets their texts and
    links them: both return one row a member at most.
    """
    met = _meetings(crowds.join(labels, "id")).select(
        F.xxhash64("region", "u", "v").alias("meeting"), "side", "id", "n", "component"
    )
    schema = "meeting bigint, side int, id bigint, n bigint, component bigint"
    named = store(met.join(marks, "id").groupBy("meeting").applyInArrow(name_candidates, schema), "meetings")
    links = named.join(texts, "id").groupBy("meeting").applyInArrow(
        confirm_meeting, "a bigint, b bigint, of_a bigint, of_b bigint"
    )
    return _joined(labels, links)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Empty sets are linked with nothing. Rows that share a doc_id count as one document.
    A row without doc_id is linked to equal sets alone; it is kept if there is none
    with a doc_id. No other column is read.
    """
    drawn = store(sketch(docs), "sketches")
    by_set = drawn.where("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"),
        F.first("marks").alias("marks"),
    )
    by_set = store(by_set, "sets")
    groups = linked_groups(docs, by_set.select("id", "n", "keys", "marks"))
    named = by_set.select("set_a", "set_b", "id").join(groups, "id", "left")
    named = named.select("set_a", "set_b", F.coalesce("component", "id").alias("component_id"))
    rows = drawn.drop("keys", "marks").join(named, ["set_a", "set_b"], "left")
    component = F.coalesce("component_id", "doc_id")
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.col("component_id").isNull()).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest doc_id; rows
    without doc_id stay."""
    gone = near_duplicates(docs).where("not kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def op7_lsh_forest(spark, docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)
