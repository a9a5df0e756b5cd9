"""Repeated passages against every window of every text."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfmark.llm import repeats

from .conftest import documents, messy_rows


def windows(texts):
    return Counter(b[i : i + 200] for b in texts for i in range(len(b) - 199))


def brute(rows):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    texts = [(t or "").encode() for _, t in rows]
    times, out = windows(texts), []
    for (doc_id, _), text in zip(rows, texts):
        gone = bytearray(len(text))
        for i in range(len(text) - 199):
            if times[text[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(seed):
    """Texts that share passages of 100 to 800 bytes, cut anywhere."""
    chosen = random.Random(seed)
    words = ["".join(chosen.choice("abcdefghij") for _ in range(chosen.randint(2, 7))) for _ in range(40)]

    def prose(n):
        return " ".join(chosen.choice(words) for _ in range(n))

    shared, texts = [prose(chosen.randint(20, 120)) for _ in range(12)], []
    for _ in range(150):
        parts = [prose(chosen.randint(0, 40))]
        for _ in range(chosen.randint(0, 3)):
            passage = chosen.choice(shared)
            half = len(passage) // 2
            parts += [passage[chosen.randint(0, half) : chosen.randint(half, len(passage))], prose(chosen.randint(0, 30))]
        texts.append(" ".join(parts))
    long = prose(2500)
    texts += texts[:15] + [long[:5000] + prose(30) + long[5000:], long]
    return texts + ["a" * 1000, "ab" * 700, "é" * 500, None, "", "x" * 199, "x" * 199, "y" * 200, "z" * 201]


@pytest.mark.parametrize("section,part", [(repeats.SECTION, repeats.PART), (5, repeats.PART), (repeats.SECTION, 900)])
def test_all_windows(spark, monkeypatch, section, part):
    # A small section sends most passages through the count of windows; small parts cut texts.
    monkeypatch.setattr(repeats, "PART", part)
    rows = list(enumerate(passages(5)))
    got = repeats.Repeats(documents(spark, [t for _, t in rows]).repartition(5), section).documents()
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == brute(rows)


def test_parts_hold_all_windows():
    sizes = [200, 5000, 300, 300, 300, 2000, 1000]
    offsets = np.cumsum([0, *sizes])
    held = [set() for _ in sizes]
    for start, end, ends, first in repeats._parts(offsets, 1000):
        assert end - start <= 1000 + 199
        for n, stop in enumerate(ends):
            begin = start + (ends[n - 1] if n else 0)
            held[first + n] |= set(range(begin - offsets[first + n], start + stop - 199 - offsets[first + n]))
    assert held == [set(range(size - 199)) for size in sizes]


def test_messy_rows(spark, messy, nothing):
    rows = [r[:2] for r in messy_rows()]
    got = sorted((tuple(r) for r in repeats.op11_repeats(spark, messy).collect()), key=str)
    assert got == brute(rows)
    assert repeats.op11_repeats(spark, nothing).collect() == []


def test_section_against_all_pairs():
    chosen = random.Random(8)
    for _ in range(40):
        n = chosen.randint(2, 40)
        left = ["".join(chosen.choice("ab") for _ in range(4)).encode() + b"l" * 150 for _ in range(4)]
        right = [b"r" * 170 + bytes([97 + i]) + b"s" * chosen.choice([10, 29]) for i in range(3)]
        members = sorted({(chosen.choice(right), chosen.choice(left)[: chosen.choice([20, 60, 154])]) for _ in range(n)})
        rights, lefts = [r for r, _ in members], [x for _, x in members]

        def common(a, b):
            return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

        groups = []
        got = repeats.scan_section(rights, lefts, groups)
        want = [[0] * len(members), [0] * len(members)]
        maximal = defaultdict(set)
        for i in range(len(members)):
            for j in range(i):
                x, y = common(lefts[i], lefts[j]), common(rights[i], rights[j])
                if x + y >= 200:
                    maximal[x, y, lefts[i][:x], rights[i][:y]] |= {i, j}
                    for m in (i, j):
                        want[0][m], want[1][m] = max(want[0][m], x), max(want[1][m], y)
        assert list(map(list, got)) == want
        # Every maximal repeat comes with all its occurrences.
        found = defaultdict(set)
        for x, y, held in groups:
            found[x, y, lefts[held[0]][:x], rights[held[0]][:y]] |= set(held)
        occurrences = {
            (x, y, a, b): {i for i in range(len(members)) if lefts[i][:x] == a and rights[i][:y] == b}
            for x, y, a, b in maximal
        }
        assert {key: found[key] for key in occurrences} == occurrences


def test_groups_name_all_occurrences(spark):
    passage = " ".join(f"passage{i}" for i in range(30))
    texts = [f"{i} before {passage} after {i * 7}" for i in range(6)] + ["nothing of the kind " * 3]
    found = repeats.Repeats(documents(spark, texts)).groups().collect()
    longest = max(r.n_bytes for r in found)
    best = [r for r in found if r.n_bytes == longest]
    assert longest >= 200 and len({(r.text_a, r.text_b) for r in found}) == 6
    whole = defaultdict(set)
    for r in best:
        whole[r.repeat].add((r.text_a, r.text_b))
    assert max(map(len, whole.values())) >= 2
