import random

import pytest

from shelfmark.llm import common

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, size string, "
    "copies string, kept string, key string, queue string, dropped string, n_words string, part string"
)
WORDS = "the of and to in is red blue green stone river mountain was that for".split()


def prose(seed, n):
    chosen = random.Random(seed)
    return " ".join(chosen.choice(WORDS) + ("q" + chr(97 + chosen.randint(0, 25))) * chosen.randint(0, 3) for _ in range(n))


def messy_rows():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    rows = [
        (None, None, None, None, None),
        (None, "lone words of a row without an id", "en", "a", 3),
        (1, None, "en", "a", 0),
        (2, "", "en", None, 0),
        (3, " \t\n ", "en", "a", 4),
        (4, "word", None, "b", 4),
        (5, "word", "en", "b", None),
        (6, prose(1, 60), "en", "b", 10),
        (6, prose(1, 60), "en", "b", 10),
        (7, prose(1, 60), "fr", "c", 10),
        (8, prose(2, 30_000), "en", "c", 10),
        (9, "x" * 300_000, "en", "d", 300_000),
        (10, "cc by " * 40 + "\n\n\n", "de", "d", 1),
        (11, "é日本語    ½ 🙂 <|endoftext|> İK", "fr", "e", 1),
        (-5, prose(3, 25) + "\r\n" + prose(3, 25), "es", "é", 2),
        (1 << 60, prose(4, 25), "es", "z", 2),
    ]
    return [(*r, *["x"] * 9) for r in rows]


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, texts, sources=None):
    sources = sources or ["a"] * len(texts)
    rows = [(i, t, "en", s, len(t or "")) for i, (t, s) in enumerate(zip(texts, sources))]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


assert common.DOCUMENT == ("doc_id", "text", "lang", "source", "n_chars")
