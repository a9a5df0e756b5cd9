"""Licence texts found by diagonal voting; DataFrame operations only.

Every pair of neighbouring words of every document is joined, by hash, to the places
where the pair stands in a licence template. A hit votes for the diagonal
``document place - template place``: words copied in order share one. Votes are added
up by document, template and diagonal. Diagonals that lie close together (words put
in or left out shift them) merge into one span, and a span is verified by the share
of the template's pairs that it holds.

The base phrases are templates too; they must match whole, on one diagonal.
The templates are a fixed list, so their side of the join is small by construction.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import store

#: Words of a gram.
GRAM = 2
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The template that every document's end stands for.
END = -1

#: The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Opening words of well-known notices, and the labels they give.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license": "apache-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu general public license version 2": "gpl-2.0",
    "this program is free software you can redistribute it and or modify it under the terms of the "
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "mozilla public license": "mpl",
    "all rights reserved": "all-rights-reserved",
}


@dataclass(frozen=True)
class Settings:
    #: Least share of a notice's pairs that a span must hold.
    coverage: float = 0.9
    #: Diagonals at most this far apart belong to one span.
    drift: int = 2


def _templates(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """One row for each gram of each template, and one that marks a document's end."""
    rows = [(END, "", False, 0, 0, None, None)]
    listed = [(p, label, True) for p, label in phrases.items()]
    listed += [(p, label, False) for p, label in notices.items()]
    for number, (phrase, label, base) in enumerate(listed):
        words = phrase.split()
        if len(words) < GRAM or not re.fullmatch(r"[a-z0-9 ]+", phrase):
            raise ValueError(f"not a phrase of {GRAM} or more plain words: {phrase!r}")
        grams = len(words) - GRAM + 1
        rows += [(number, label, base, grams, at, words[at], words[at + 1]) for at in range(grams)]
    frame = spark.createDataFrame(
        rows, "template int, label string, base boolean, grams int, at int, one string, two string"
    )
    return frame.withColumn("gram", _gram(F.col("one"), F.col("two"))).drop("one", "two")


def _gram(one: Column, two: Column) -> Column:
    """64 bits: with fewer than a hundred template grams, a false hit is not to be
    expected in 10 ** 16 words. The end mark hashes no words."""
    return F.xxhash64(F.lit("gram"), one, two)


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in lower case. A null text has none."""
    text = F.coalesce(text, F.lit(""))
    # ``lower`` also turns these two letters into ASCII ones; any other letter will do.
    odd = text.contains("\u212a") | text.contains("\u0130")
    plain = F.when(odd, F.translate(text, "\u212a\u0130", "\u00df\u00df")).otherwise(text)
    return F.array_remove(F.split(F.lower(plain), _NOT_WORD), "")


def diagonal_votes(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES
) -> DataFrame:
    """Votes by document, template and diagonal: key, template, label, base, grams,
    diagonal, found (places in the template), start, end, rows.

    Equal rows vote together: ``found`` is a set. Each document has a vote for the
    template END, whose start is its number of words and whose rows are its equal rows.
    """
    templates = F.broadcast(_templates(docs.sparkSession, phrases, notices))
    key = F.struct(
        "doc_id", F.xxhash64(F.lit(1), "text").alias("a"), F.xxhash64(F.lit(2), "text").alias("b")
    )

    def grams(words: Column) -> Column:
        # The last word has no next one and makes no gram of two words.
        rolled = F.zip_with(words, F.slice(words, GRAM, F.greatest(F.size(words), F.lit(1))), _gram)
        return F.array_append(rolled, _gram(F.lit(None), F.lit(None)))

    rolled = F.transform(F.array(words_of(F.col("text"))), grams)[0]
    rolled = docs.select(key.alias("key"), F.posexplode(rolled).alias("place", "gram"))
    hits = rolled.join(templates, "gram").withColumn("diagonal", F.col("place") - F.col("at"))
    return hits.groupBy("key", "template", "label", "base", "grams", "diagonal").agg(
        F.collect_set("at").alias("found"), F.min("place").alias("start"), F.max("place").alias("end"),
        F.count(F.lit(1)).alias("rows"),
    )


def verified_spans(votes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Spans of neighbouring diagonals that hold enough of their template: key,
    template, label, base, start, last (word places), coverage."""
    whole = votes.where(F.col("base") & (F.size("found") == F.col("grams")))
    by = Window.partitionBy("key", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(by) > settings.drift
    merged = (
        votes.where(~F.col("base") & (F.col("template") != END))
        .withColumn("span", F.sum(F.when(apart, 1).otherwise(0)).over(by))
        .groupBy("key", "template", "label", "base", "grams", "span")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("found")))).alias("n"),
            F.min("start").alias("start"), F.max("end").alias("end"),
        )
        .where(F.col("n") >= settings.coverage * F.col("grams"))
    )
    last = (F.col("end") + F.lit(GRAM - 1)).alias("last")
    return whole.select(
        "key", "template", "label", "base", "start", last, F.lit(1.0).alias("coverage")
    ).unionByName(
        merged.select(
            "key", "template", "label", "base", "start", last, (F.col("n") / F.col("grams")).alias("coverage")
        )
    )


def scan_licenses(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, notices.

    Equal rows (doc_id and text) get equal results. A null or empty text has no words
    and score 0. The score is the best coverage of any span. Other columns are left
    out, whatever their names.
    """
    votes = store(diagonal_votes(docs), "votes")
    base = F.when(F.col("base"), F.col("start"))
    labels = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    found = verified_spans(votes, settings).groupBy("key").agg(
        F.count(base).alias("n_base"), F.min(base).alias("first_word"), F.max(base).alias("last_word"),
        labels(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        labels("label").alias("labels"),
        F.max("coverage").alias("score"),
        F.count(F.when(~F.col("base"), 1)).alias("notices"),
    )
    counted = votes.where(F.col("template") == END).select("key", F.col("start").alias("n_words"), "rows")
    # A struct key joins null doc_ids too.
    joined = counted.join(found, "key", "left")
    return joined.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows")))).select(
        "key.doc_id", F.col("n_words").cast("bigint").alias("n_words"),
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        F.col("first_word").cast("bigint").alias("first_word"),
        F.col("last_word").cast("bigint").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.coalesce("notices", F.lit(0)).cast("bigint").alias("notices"),
    )


def op2_license_scan(spark, docs: DataFrame) -> DataFrame:
    return scan_licenses(docs)
