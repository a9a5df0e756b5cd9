"""Quality rules, licence scan and line templates against plain Python."""

import math
import re
from collections import Counter
from random import Random

from shelfmark.llm import license_scan, line_dedup, quality

from .conftest import documents, messy_rows, prose


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered.update(range(i, i + 8))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_quality_counts(spark, messy):
    loop = " ".join(["a b c d e f g"] * 9)
    texts = [loop, prose(1, 50) + " " + prose(1, 50), "x\ny\nx\n\n \nx", "#" * 30, prose(5, 7), prose(6, 8) + " " + prose(6, 9)]
    docs = documents(spark, texts).select("doc_id", "text").unionByName(messy.select("doc_id", "text"))
    got = quality.op6_quality(spark, docs).collect()
    want = Counter((i, *counts(t)) for i, t in enumerate(texts))
    want.update((r[0], *counts(r[1] or "")) for r in messy_rows())
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[n] for n in names) for r in got) == want
    assert all(not (r["kept"] and r["base_failed"]) for r in got)


def test_rules_are_a_table(spark):
    docs = documents(spark, ["the " * 5 + prose(1, 30), prose(2, 30) + " |||||||||||||||||||||"])
    strict = quality.judge(docs, [quality.Rule("n_words", most=34), quality.Rule("symbols_per_word", most=0.5)])
    assert [r["failed_rules"] for r in strict.orderBy("row.doc_id").collect()] == ["n_words", "symbols_per_word"]


def base_places(text):
    lowered = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    found = [
        (i, label) for phrase, label in license_scan.PHRASES.items() for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in found]
    labels = ",".join(sorted({label for _, label in found}))
    return len(words), len(found), min(starts, default=None), max(starts, default=None), labels


def test_license_base(spark, messy):
    texts = [
        "MIT License mit-license, the CC-BY. GNU General Public License gnu general", "mit", "mité license",
        "mİt license Apache License", "cc by " * 50, "gnu gnu general public license license",
    ]
    docs = documents(spark, texts).select("doc_id", "text").unionByName(messy.select("doc_id", "text"))
    got = license_scan.op2_license_scan(spark, docs).collect()
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    want = Counter((i, *base_places(t)) for i, t in enumerate(texts))
    want.update((r[0], *base_places(r[1] or "")) for r in messy_rows())
    assert Counter(tuple(r[n] for n in names) for r in got) == want


def test_license_notices_survive_an_edit(spark):
    notice = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    ).split()
    texts = [" ".join(notice), " ".join(notice[:8] + ["really"] + notice[8:]), " ".join(notice[:5]), " ".join(reversed(notice))]
    got = license_scan.op2_license_scan(spark, documents(spark, texts)).orderBy("doc_id").collect()
    assert [r["labels"] for r in got] == ["mit", "mit", "", ""]
    assert got[0]["score"] == 1 and 0.9 <= got[1]["score"] < 1 and got[2]["score"] == 0
    assert all(r["base_labels"] == "" for r in got)


def templates_in_python(texts, settings):
    lines = []
    for doc_id, text in enumerate(texts):
        for number, line in enumerate((text or "").split("\n") if text is not None else []):
            tokens = tuple(
                "<*>" if re.search("[0-9]", t) else t for t in re.findall(r"[^ \t-\r]+", line)
            )
            constant = sum(t != "<*>" for t in tokens)
            if tokens and constant >= settings.constant * len(tokens):
                lines.append((doc_id, number, tokens))
    shapes = {}
    for doc_id, number, tokens in lines:
        shapes.setdefault(tokens, []).append((doc_id, number))
    order = {s: i for i, s in enumerate(sorted(shapes, key=lambda s: (-len(shapes[s]), shapes[s][0])))}
    meetings = {}
    for shape in shapes:
        n = len(shape)
        if n >= settings.min_tokens:
            bands = n - math.ceil(settings.similarity * n) + 1
            rest = list(enumerate(shape[settings.depth :]))
            for band in range(bands):
                for inside in (True, False) if bands > 2 else (True,):
                    held = tuple(t for i, t in rest if (i % bands == band) == inside)
                    meetings.setdefault((n, shape[: settings.depth], band, inside, held), []).append(shape)
    up = {}
    for members in meetings.values():
        head = min(members, key=order.get)
        for shape in members:
            alike = sum(a == b for a, b in zip(shape, head))
            if shape != head and alike >= settings.similarity * len(head):
                up[shape] = min(up.get(shape, head), head, key=order.get)
    found = {}
    for shape, places in shapes.items():
        while shape in up:
            shape = up[shape]
        found.setdefault(shape, []).extend(places)
    dropped = set()
    for shape, places in found.items():
        least = settings.min_documents if len(shape) >= settings.min_tokens else settings.short_documents
        if len({d for d, _ in places}) >= least:
            dropped |= set(places) - {min(places)}
    return dropped


def dropped_by_spark(spark, texts):
    got = line_dedup.drop_recurring_lines(documents(spark, texts)).collect()
    return {r["row"]["doc_id"]: r["n_dropped"] for r in got}


def test_a_leaf_holds_several_templates(spark):
    names = [f"{a}{b}{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyz"[:3]]
    family = [f"posted by the editor {name} this morning" for name in names]
    other = ["posted by the staff of our newsroom"] * 2
    for texts in (family, family + other, other + family):
        dropped = dropped_by_spark(spark, texts)
        assert sum(dropped.values()) == len(names) - 1
        assert templates_in_python(texts, line_dedup.Settings()) == {(d, 0) for d, n in dropped.items() if n}


def drops_of_all_links(texts, settings):
    """Documents of one line each that lose it, where all pairs of shapes are compared."""
    shapes = {}
    for doc_id, text in enumerate(texts):
        shapes.setdefault(tuple(text.split()), []).append(doc_id)
    names = {shape: shape for shape in shapes}
    for one in shapes:
        for other in shapes:
            if len(one) == len(other) and one[: settings.depth] == other[: settings.depth]:
                if sum(a == b for a, b in zip(one, other)) >= settings.similarity * len(one):
                    old, new = names[one], names[other]
                    names = {shape: new if name == old else name for shape, name in names.items()}
    found = {}
    for shape, places in shapes.items():
        found.setdefault(names[shape], []).extend(places)
    return {d: 1 for places in found.values() if len(places) >= settings.min_documents for d in places if d != min(places)}


def test_no_link_of_a_leaf_is_left_out(spark, monkeypatch):
    # Two words vary and one may: all is connected, but most shapes do not resemble the commonest.
    grid = [f"posted by the editor {a}{b} this {day}" for a in "abcd" for b in "efg" for day in "uvwxyz"]
    # Sparse links among shapes that share common words, for several numbers of tokens.
    random = Random(7)
    sparse = [
        " ".join(["it", "was", "the", *(random.choice(words) for _ in range(n - 3))])
        for n, words, times in ((6, "pqrstuvw", 60), (8, "pqrstu", 60), (9, "pqrst", 60), (13, "pqr", 60)) for _ in range(times)
    ]
    texts = grid + sparse
    settings = line_dedup.Settings()
    want = drops_of_all_links(texts, settings)
    assert sum(d in want for d in range(len(grid))) == len(grid) - 1
    assert 0 < sum(d >= len(grid) for d in want) < len(sparse) - 4
    # As registered, and all groups split once, then compared in parts of few members.
    for crowd, splits, part in ((line_dedup.CROWD, line_dedup.SPLITS, line_dedup.PART), (0, 1, 3)):
        monkeypatch.setattr(line_dedup, "CROWD", crowd)
        monkeypatch.setattr(line_dedup, "SPLITS", splits)
        monkeypatch.setattr(line_dedup, "PART", part)
        dropped = dropped_by_spark(spark, texts)
        assert {d: n for d, n in dropped.items() if n} == want


def test_short_lines_go_by_a_higher_count(spark):
    texts = [f"{prose(i, 20)}\nAll rights reserved." + "\nThe end" * (i < 19) for i in range(25)]
    dropped = dropped_by_spark(spark, texts)
    assert dropped == {i: int(i > 0) for i in range(25)}


def test_line_templates(spark):
    texts = []
    for i in range(30):
        text = [prose(i, 12), f"Page {i} of 30 in this volume", f"Printed by hand for reader {'abc'[i % 3]}nn today"]
        text += ["All rights reserved by us"] * (i % 4) + ["short line", "1 2 3 4 5 and 6"] + [prose(100 + i // 2, 9)]
        texts.append("\n".join(text))
    texts += [None, "", texts[0], texts[0]]
    settings = line_dedup.Settings()
    dropped = templates_in_python(texts, settings)
    got = line_dedup.drop_recurring_lines(documents(spark, texts), settings).collect()
    for r in got:
        doc_id, text = r["row"]["doc_id"], texts[r["row"]["doc_id"]]
        if text is None:
            assert r["row"]["text"] is None and r["n_lines"] == 0
            continue
        lines = text.split("\n")
        assert r["n_lines"] == len(lines)
        assert r["row"]["text"] == "\n".join(x for i, x in enumerate(lines) if (doc_id, i) not in dropped)
    assert any("Page 0 of" in r["row"]["text"] for r in got if r["row"]["text"])
    assert sum("Page" in (r["row"]["text"] or "") for r in got) == 1


def test_native_plans(spark, messy):
    for name, df in (
        ("lines", line_dedup.drop_recurring_lines(messy)), ("licences", license_scan.scan_licenses(messy)),
        ("rules", quality.judge(messy)),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan), name


def test_a_line_is_cut_only_where_it_is_odd(spark):
    texts = [" a b ", "a b", "a\tb", "a  b", "\x0ba b\r", "", " ", "\t", "a1 <*> b", "<*> b <*>c", "x9\x0c9 9", "é ü a<b 1é2", "a b"]
    settings = line_dedup.Settings(min_tokens=1, constant=0.0)
    lines = line_dedup._lines(documents(spark, texts), settings)
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert "text#" not in plan.split("Generate")[0]  # a text is hashed once, not for each of its lines
    got = {r["doc_id"]: r for r in lines.collect()}
    tokens = [tuple("<*>" if re.search("[0-9]", t) else t for t in re.findall(r"[^ \t-\r]+", x)) for x in texts]
    assert {i: r["size"] for i, r in got.items()} == {i: len(t) for i, t in enumerate(tokens) if t}
    for name, key in (("shape", lambda t: t), ("leaf", lambda t: (len(t), t[:3]))):
        pairs = {(key(tokens[i]), (r[f"{name}_a"], r[f"{name}_b"])) for i, r in got.items()}
        assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
