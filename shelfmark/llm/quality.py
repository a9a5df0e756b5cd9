"""Quality rules: a table of thresholds compiled into one projection.

Each rule bounds a measure of a document: length, symbols, stop words or lines. The
measures and the rules are built-in column expressions, so a document is judged where
it is read, with no shuffle and no user function.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words, as in the contract of the query.
_SPACE = " \t\n\x0b\x0c\r"
#: Symbols that are counted.
_SYMBOLS = "#*$%&|<>"

#: The commonest function words of the four languages.
STOP_WORDS = tuple(
    (
        "the of and to in a is that it for was on with as be at by this are from or an not "
        "der die das und in den von zu mit ist ein eine auf für nicht sich des dem "
        "le la les de des et un une en du que qui dans pour pas sur par au "
        "el los las y que del se por con una su no es lo"
    ).split()
)

#: Words of a repeated window, and the least length and most repeats of a base document.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie between the bounds that are given."""

    measure: str
    least: float | None = None
    most: float | None = None

    def fails(self) -> Column:
        value = F.col(self.measure)
        failed = F.lit(False)
        if self.least is not None:
            failed |= value < F.lit(float(self.least))
        if self.most is not None:
            failed |= value > F.lit(float(self.most))
        return failed


RULES = (
    Rule("mean_word_length", least=2.0, most=15.0),
    Rule("symbols_per_word", most=0.3),
    Rule("shouting", most=0.5),
    Rule("stop_word_share", least=0.01),
    Rule("duplicate_line_share", most=0.5),
)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window that occurs twice or more in the array."""

    def covered(hashes: Column) -> Column:
        # Positions sorted by window; equal windows are neighbours.
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def again(s: Column) -> Column:
            same = F.filter(
                s,
                lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"]))
                | ((i < F.size(s) - 1) & (F.get(s, i + 1)["h"] == x["h"])),
            )
            return F.array_sort(F.transform(same, lambda x: x["i"]))

        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("end"))
        return _let(
            pairs,
            lambda s: F.aggregate(
                again(s),
                start,
                lambda a, i: F.struct(
                    (a["n"] + F.least(F.lit(WINDOW), i + WINDOW - a["end"])).alias("n"),
                    (i + WINDOW).alias("end"),
                ),
                lambda a: a["n"],
            ),
        )

    def of_hashes(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(covered(hashes))

    def of_words(ids: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(1), F.size(ids) - WINDOW + 1), lambda i: F.xxhash64(F.slice(ids, i, WINDOW))
        )
        return _let(windows, of_hashes)

    ids = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= WINDOW, 0).otherwise(_let(ids, of_words)).cast("bigint")


def measures(text: Column) -> dict[str, Column]:
    """Counts of a text from which the rules' measures are worked out.

    A null text counts as empty. Lines are split at line feeds; a line counts if it
    has a word, and is a duplicate if it equals an earlier one.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, "[ \\t-\\r]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, _SPACE, "")) > 0)
    solid = F.translate(text, _SPACE, "")
    return {
        "words": words,
        "lines": lines,
        "word_chars": F.length(solid),
        "n_symbols": F.length(text) - F.length(F.translate(text, _SYMBOLS, "")),
        "n_shouts": F.length(text) - F.length(F.translate(text, "!", "")),
    }


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Each row of ``docs`` as the struct ``row``, its counts and measures,
    ``base_failed``, the ``failed_rules`` and ``kept``.

    A document without words, a null text included, fails the base rule (fewer than
    MIN_WORDS words). Rows are judged one by one; other columns are carried, whatever
    their names.
    """
    row = F.struct(*docs.columns).alias("row")
    counted = docs.select(row, *(c.alias(f"_{name}") for name, c in measures(F.col("text")).items()))
    words, lines = F.col("_words"), F.col("_lines")
    stops = F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))
    counted = counted.withColumns(
        {
            "n_words": F.size(words).cast("bigint"),
            "word_chars": F.col("_word_chars").cast("bigint"),
            "n_symbols": F.col("_n_symbols").cast("bigint"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
            "n_repeat_words": _repeat_words(words),
            "n_stop_words": F.size(stops).cast("bigint"),
            "n_lines": F.size(lines).cast("bigint"),
            "n_shouts": F.col("_n_shouts").cast("bigint"),
        }
    ).drop("_words", "_lines", "_word_chars", "_n_symbols", "_n_shouts")
    per_word = F.greatest(F.col("n_words"), F.lit(1))
    judged = counted.withColumns(
        {
            "mean_word_length": F.col("word_chars") / per_word,
            "symbols_per_word": F.col("n_symbols") / per_word,
            "shouting": F.col("n_shouts") / per_word,
            "stop_word_share": F.col("n_stop_words") / per_word,
            "duplicate_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
            "base_failed": (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        }
    )
    failed = F.concat_ws(",", *(F.when(rule.fails(), F.lit(rule.measure)) for rule in rules))
    judged = judged.withColumn("failed_rules", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))


def op6_quality(spark, docs: DataFrame) -> DataFrame:
    return judge(docs.select("doc_id", "text")).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failed_rules",
    )
