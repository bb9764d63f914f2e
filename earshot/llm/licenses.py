"""License texts by exact set-similarity join with templates.

A template is found in a text where a run of as many words as the template has
holds at least ``containment`` of its distinct words, the words that name its
license among them and no word that names another. Runs are looked for in
blocks of words. Words are put in the order of
their frequency in the corpus, rarest first. If a template of m words must
share o of them, one of its m - o + 1 rarest words is in the block, so blocks
meet templates only on those (prefix); blocks with fewer template words than o
are left out before (length), and a pair goes on only while the words left on
either side can still make up o (position). In every pair left, all runs of
the block are counted.
"""

from __future__ import annotations

from fractions import Fraction
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import TAG, lower_ascii, numbered
from earshot.session import stage

WORD_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CONTAINMENT = Fraction(4, 5)
# blocks have two steps of words and start at every step, so any step of words in a row is in one block;
# the step is the longest template's length, this at least
STEP = 32


class Template(NamedTuple):
    """Words by which a license is given: ``naming`` ones must stand in a run, ``other`` ones must not."""

    label: str
    text: str
    naming: str = ""
    other: str = ""

    @property
    def words(self) -> list[str]:
        return sorted(set(self.text.split()))

    @property
    def span(self) -> int:
        return len(self.text.split())


# Phrases that name a license, by label.
PHRASES = {
    "mit": "mit license",
    "apache": "apache license",
    "gpl": "general public license",
}

# Sentences by which licenses are given, by label, with the words that tell them from others.
TEMPLATES = [
    Template("mit", "released under the mit license", "mit"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                    "associated documentation files to deal in the software without restriction"),
    Template("apache", "licensed under the apache license version 2 0", "apache"),
    Template("apache", "you may not use this file except in compliance with the license you may obtain a copy of the "
                       "license at"),
    Template("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                    "general public license as published by the free software foundation", "gnu general public"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
                    "provided that the following conditions are met"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc", "sa nd"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
             "creative commons attribution", "noncommercial sharealike noderivatives"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla"),
    Template("reserved", "all rights reserved", "all rights reserved"),
]


def plain(text: Column) -> Column:
    """Words of ``text`` in ASCII lower case with one space before and after each; null as empty."""
    lower = lower_ascii(F.coalesce(text.cast("string"), F.lit("")))
    return F.regexp_replace(F.concat(F.lit(" "), lower, F.lit(" ")), WORD_BREAKS, " ")


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


# the most words of a template in a run of the block that names its license and no other
RUN_SHARED = """array_max(transform(
    transform(sequence(0, greatest(size(words) - span, 0)), i -> slice(words, i + 1, span)),
    run -> IF(size(array_except(naming, run)) = 0 AND NOT arrays_overlap(run, other), size(array_intersect(run, own)), 0)))"""


def needed(words: int, containment: Fraction) -> int:
    return max(1, ceil(words * containment))


def _phrase_columns(phrases: dict[str, str]) -> dict[str, Column]:
    """Counts, first and last place of the phrases in ``plain``, and the labels of those found.

    No phrase may begin with the end of another, so places never overlap.
    """
    any_phrase = "(?:" + "|".join(phrases.values()) + ")"
    found = F.col("plain").rlike(f"(?<= ){any_phrase}(?= )")
    n_base = F.when(found, F.regexp_count("plain", F.lit(f"(?<= ){any_phrase}(?= )"))).otherwise(F.lit(0))
    ahead = F.regexp_extract("plain", f"^(?s)(.*?)(?<= ){any_phrase} ", 1)
    ahead_of_last = F.regexp_extract("plain", f"^(?s)(.*)(?<= ){any_phrase} ", 1)
    return {
        "n_words": (_spaces(F.col("plain")) - 1).cast("bigint"),
        "n_base": n_base.cast("bigint"),
        "first_word": F.when(found, (_spaces(ahead) - 1).cast("bigint")),
        "last_word": F.when(found, (_spaces(ahead_of_last) - 1).cast("bigint")),
        "base_labels": F.array_compact(F.array(*[
            F.when(found & F.contains("plain", F.lit(f" {phrase} ")), F.lit(label))
            for label, phrase in phrases.items()
        ])),
    }


def scan(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates=None, phrases=None,
    containment: Fraction = CONTAINMENT, step: int = STEP,
) -> tuple[DataFrame, DataFrame]:
    """Documents with their phrases, and the blocks that hold a template.

    Documents: ``row_tag``, ``doc_id``, ``n_words``, ``n_base``, ``first_word``,
    ``last_word`` and ``base_labels``, a row for every row of ``docs``. Blocks:
    ``row_tag``, ``block_start``, ``template`` (its number), ``label`` and
    ``share`` of the template's words. A text shorter than a block is one
    block and, if shorter than a template, one run; null and empty texts have
    no words and no block. A very long text becomes many blocks of two steps.
    Repeated rows get equal results, an empty table gives no rows, and other
    columns of ``docs`` are not read, so none can clash. ``templates`` holds
    ``Template`` or pairs of label and text. Blocks are as long as the longest
    needs, but have two ``step`` of words at least. ``share`` is the largest of
    a block's runs.
    """
    spark = docs.sparkSession
    templates = [Template(*t) for t in (TEMPLATES if templates is None else templates)]
    sets = [(i, t.label, t.words) for i, t in enumerate(templates)]
    step = max([step, *(t.span for t in templates)])
    vocabulary = sorted({word for _, _, words in sets for word in words})
    source = numbered(docs.select(id_column, text_column))

    words = F.split(F.trim("plain"), " ")
    hits = F.array_intersect(words, F.array(*map(F.lit, vocabulary)))
    # length: the whole text must hold enough of some template
    possible = F.lit(False)
    for _, _, own in sets:
        shared = F.size(F.array_intersect("hits", F.array(*map(F.lit, own))))
        possible = possible | (shared >= needed(len(own), containment))
    columns = _phrase_columns(PHRASES if phrases is None else phrases)
    rows = stage(
        source.select(TAG, F.col(id_column).alias("doc_id"), plain(F.col(text_column)).alias("plain"))
        .withColumn("hits", hits)
        .select(TAG, "doc_id", *[c.alias(k) for k, c in columns.items()], "hits",
                F.when(possible, F.col("plain")).alias("plain")),
        "license-rows",
    )

    # the global order: template words by the number of documents with them
    counts = {r.word: r.n for r in rows.select(F.explode("hits").alias("word")).groupBy("word")
              .agg(F.count("*").alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    ordered = F.array(*map(F.lit, order))
    place = {word: i for i, word in enumerate(order)}
    index = []
    for number, label, own in sets:
        ranked = sorted(own, key=place.__getitem__)
        least = needed(len(ranked), containment)
        for position, word in enumerate(ranked[:len(ranked) - least + 1]):
            index.append((number, label, word, position, len(ranked), least, ranked, templates[number].span,
                          templates[number].naming.split(), templates[number].other.split()))
    # bounded by the templates
    index_table = F.broadcast(spark.createDataFrame(
        index, "template int, label string, word string, position int, length int, least int, own array<string>, "
               "span int, naming array<string>, other array<string>"
    ))

    fewest = min(needed(len(own), containment) for _, _, own in sets)
    starts = F.expr(f"sequence(0, greatest(size(words) - {step} - 1, 0), {step})")
    blocks = (
        rows.where("plain is not null")
        .select(TAG, F.split(F.trim("plain"), " ").alias("words"))
        .withColumn("block_start", F.explode(starts))
        .select(TAG, "block_start", F.slice("words", F.col("block_start") + 1, F.lit(2 * step)).alias("words"))
        .withColumn("block", F.array_intersect(ordered, "words"))
        .where(F.size("block") >= fewest)
    )
    met = blocks.select(TAG, "block_start", "block", "words", F.posexplode("block").alias("at", "word")).join(
        index_table, "word"
    )
    room = 1 + F.least(F.col("length") - F.col("position") - 1, F.size("block") - F.col("at") - 1)
    shared = F.size(F.array_intersect("block", "own"))
    found = (
        met.where(F.size("block") >= F.col("least"))
        # the first word both have is the one they meet on, so nothing before it counts
        .where(room >= F.col("least"))
        .where((shared >= F.col("least")) & (F.size(F.array_except("naming", "block")) == 0))
        # a block and a template may meet on several prefix words
        .groupBy(TAG, "block_start", "template", "label").agg(*[
            F.first(c).alias(c) for c in ("words", "own", "span", "naming", "other", "least", "length")
        ])
        .withColumn("shared", F.expr(RUN_SHARED))
        .where(F.col("shared") >= F.col("least"))
        .select(TAG, "block_start", "template", "label", (F.col("shared") / F.col("length")).alias("share"))
    )
    return rows.drop("hits", "plain"), found


def license_labels(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``row_tag``, the document columns of ``scan``, ``labels`` and ``score`` for every row of ``docs``.

    Labels are distinct, sorted and comma-joined, without any the empty text.
    ``score`` is the largest share of a template found, 1 where a phrase
    stands, else 0.
    """
    rows, blocks = scan(docs, id_column, text_column, **options)
    best = blocks.groupBy(TAG).agg(F.max("share").alias("share"), F.collect_set("label").alias("found"))
    nothing = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("found", nothing)))
    score = F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.col("n_base") > 0, 1.0).otherwise(0.0))
    return rows.join(best, TAG, "left").select(
        TAG, "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"), score.alias("score"),
    )
