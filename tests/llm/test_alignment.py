"""Two tokenizers' alignment against sets of byte offsets."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from shelfmark.llm import alignment

from .conftest import documents, messy_rows

public_tokenizers = pytest.importorskip("public_tokenizers")


class Libraries:
    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in prints]
        letter = {chr(b): b for b in prints} | {chr(0x100 + i): b for i, b in enumerate(rest)}
        vocabulary = self.a.get_vocab().items()
        self.of_a = {i: bytes(letter[c] for c in t) for t, i in vocabulary if not t.startswith("<|")}

    def tokens(self, text):
        """Two lists of (id, bytes)."""
        if not text:
            return [], []
        a = [(i, self.of_a[i]) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        spaced = (" " + text).encode()
        same = all(b"".join(x for _, x in side) == spaced for side in (a, b))
        return (a, b) if same else ([], [])


def grouped(a, b):
    def ends(side):
        return np.cumsum([len(x) for _, x in side]).tolist()

    ends_a, ends_b = ends(a), ends(b)
    at_a, at_b = ({e: i + 1 for i, e in enumerate(x)} for x in (ends_a, ends_b))
    groups, x, y = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        groups.append(([i for i, _ in a[x : at_a[cut]]], [i for i, _ in b[y : at_b[cut]]]))
        x, y = at_a[cut], at_b[cut]
    return groups


def brute(rows):
    libraries, held, count = Libraries(), [], Counter()
    for doc_id, text in rows:
        a, b = libraries.tokens(text)
        groups = grouped(a, b)
        links = Counter()
        for one, other in groups:
            for (p, n), (q, m) in ((x, y) for x in Counter(one).items() for y in Counter(other).items()):
                links[p, q] += n * m
        count.update(links.keys())
        held.append((doc_id, len(a), len(b), groups, links))
    best = Counter()
    for (p, _), n in count.items():
        best[p] = max(best[p], n)
    out = []
    for doc_id, n_a, n_b, groups, links in held:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append(
            (
                doc_id, n_a, n_b, len(groups), sum(links.values()),
                sum(n for (p, q), n in links.items() if count[p, q] == best[p]),
                sum(n * count[k] for k, n in links.items()),
                hashlib.sha256(text.encode()).hexdigest() if text else "",
            )
        )
    return sorted(out, key=str)


def texts():
    chosen = random.Random(3)
    letters = "abcdeéüñß  .,;\n\t12日本🙂а́ж'"
    made = ["".join(chosen.choice(letters) for _ in range(chosen.randint(1, 300))) for _ in range(100)]
    made += ["the quick brown fox", "The Quick  brown\n\nfox. ", "a▁b", "▁", "<s>hi</s><|endoftext|><unk>", "<0x41>", "\x00\x01"]
    return made + [None, "", " ", "  ", "\n", "x" * 9000, "ab" * 3000, " " * 5000, "a " * 3000, "日" * 2000]


@pytest.mark.parametrize("lane,block,listed", [(2048, 32 << 20, 4096), (16, 300, 2)])
def test_alignment(spark, monkeypatch, lane, block, listed):
    monkeypatch.setattr(alignment, "LANE", lane)
    monkeypatch.setattr(alignment, "BLOCK", block)
    monkeypatch.setattr(alignment, "LISTED", listed)
    rows = list(enumerate(texts())) + [(3, texts()[3])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = sorted((tuple(r) for r in alignment.op12_alignment(spark, docs).collect()), key=str)
    assert got == brute(rows)


def test_messy_rows(spark, messy, nothing):
    got = sorted((tuple(r) for r in alignment.op12_alignment(spark, messy).collect()), key=str)
    assert got == brute([r[:2] for r in messy_rows()])
    assert alignment.op12_alignment(spark, nothing).collect() == []


@pytest.mark.parametrize("lane", [1, 7, 2048])
def test_lockstep(monkeypatch, lane):
    monkeypatch.setattr(alignment, "LANE", lane)
    chosen = np.random.default_rng(lane)
    for _ in range(50):
        sizes = chosen.integers(0, 40, 6)
        bounds = np.cumsum([0, *sizes])
        inner = np.unique(bounds[1:])
        inner = inner[inner > 0]
        ends = [np.unique(np.r_[inner, chosen.integers(1, bounds[-1] + 1, n)]) for n in (10, 60)] if bounds[-1] else [inner, inner]
        a, b = alignment.lockstep(*ends, bounds)
        assert ends[0][a].tolist() == ends[1][b].tolist() == np.intersect1d(*ends).tolist()


def test_counts_of_pairs(spark):
    found = alignment.Alignment(documents(spark, ["the fox", "the fox the", "a fox"])).counts().collect()
    assert {r["count"] for r in found if r.best} <= {1, 2, 3}
    highest = {}
    for r in found:
        highest[r.a] = max(highest.get(r.a, 0), r["count"])
    assert all(r.best == (r["count"] == highest[r.a]) for r in found)


def test_parts_give_the_whole_texts_ids():
    both = alignment.aligner(alignment.default_tokenizer(), alignment.default_pieces())
    libraries = Libraries()
    for text in texts():
        one, other = both.encode([text])
        a, b = libraries.tokens(text)
        assert np.frombuffer(one[0], "<u4").tolist() == [i for i, _ in a]
        assert np.frombuffer(other[0], "<u4").tolist() == [i for i, _ in b]
