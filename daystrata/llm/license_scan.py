"""License scans: phrases at their places, and an exact containment join of text blocks with license templates."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daystrata.llm.common import keep, text_of

# Phrases and the labels they stand for.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Templates: (label, text). A block that holds enough of a template's words gets its label.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache-2", "You may not use this file except in compliance with the License."),
    ("gpl-3", "This program is free software: you can redistribute it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike License."),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
CONTAINMENT = 0.8
# Over a line break, a template is looked for in stretches of so many times its words: real headers have words between.
SPAN = 2

# A word: ASCII letters and digits and whatever is not ASCII. Case is folded for A-Z only.
LETTER = r"0-9A-Za-z\x{80}-\x{10FFFF}"
WORDS = f"[{LETTER}]+"
BREAKS = f"[^{LETTER}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Lower-case words in their order."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), BREAKS), "")


def span_of(text: str) -> int:
    """Words of a stretch in which a template is looked for."""
    return SPAN * len(re.findall("[0-9a-z]+", text.lower()))


def template_words(text: str) -> list[str]:
    return sorted(set(re.findall("[0-9a-z]+", text.lower())))


def _phrase_pattern(phrase: str) -> str:
    return f"(?<![{LETTER}])" + BREAKS.join(phrase.split()) + f"(?![{LETTER}])"


def phrase_places(rows: DataFrame, phrases: Mapping[str, str] = PHRASES, text: str = "text") -> DataFrame:
    """``rows`` with n_words, n_base, first_word, last_word and base_found (array of labels), by looks at the text.

    A text is searched for any phrase once; only texts that have one are looked at closely. No phrase may start within
    another one's words or its own.
    """
    each = {phrase: "(?i)" + _phrase_pattern(phrase) for phrase in phrases}
    any_of = "(?:" + "|".join(map(_phrase_pattern, phrases)) + ")"
    column = F.col(text)
    count = lambda value, pattern: F.regexp_count(value, F.lit(pattern)).cast("long")
    there = F.regexp_like(column, F.lit("(?i)" + any_of))
    labels = F.array(*[F.when(F.regexp_like(column, F.lit(each[p])), label) for p, label in phrases.items()])
    none = F.lit(None).cast("long")
    return rows.withColumn("there", there).withColumns(
        {
            "n_words": count(column, WORDS),
            "n_base": F.when(F.col("there"), sum((count(column, p) for p in each.values()), F.lit(0))).otherwise(0).cast("long"),
            "first_word": F.when(F.col("there"), count(F.regexp_extract(text, f"(?is)^(.*?){any_of}", 1), WORDS)).otherwise(none),
            "last_word": F.when(F.col("there"), count(F.regexp_extract(text, f"(?is)^(.*){any_of}", 1), WORDS)).otherwise(none),
            "base_found": F.when(F.col("there"), F.array_compact(labels)).otherwise(F.array().cast("array<string>")),
        }
    ).drop("there")


def prefix_index(rows: DataFrame, templates, containment: float, text: str = "text") -> DataFrame:
    """(word, label, words, least, place, span): the words by which a block can come to hold enough of a template.

    Words are ordered by how many texts of the whole corpus hold them, rarest first. A block with ``least`` of the t
    words has one of the first t - least + 1, so only those are indexed. The index is as large as the templates.
    """
    sets = [(label, template_words(t), span_of(t)) for label, t in templates]
    known = sorted({w for _, words, _ in sets for w in words})
    counted = (
        rows.select(F.explode(F.array_intersect(F.split(F.lower(text), BREAKS), F.array(*map(F.lit, known)))).alias("word"))
        .groupBy("word")
        .count()
    )
    often = {r["word"]: r["count"] for r in counted.collect()}  # at most one row per template word
    index = []
    for label, words, span in sets:
        ordered = sorted(words, key=lambda w: (often.get(w, 0), w))
        least = max(1, math.ceil(containment * len(ordered) - 1e-9))
        index += [(w, label, ordered, least, i, span) for i, w in enumerate(ordered[: len(ordered) - least + 1])]
    schema = "word string, label string, words array<string>, least int, place int, span int"
    return rows.sparkSession.createDataFrame(index, schema)


def containing_blocks(rows: DataFrame, index: DataFrame, text: str = "text") -> DataFrame:
    """(key, label, containment) for every block of ``rows`` (key, text) that meets a template's threshold.

    A block is a line, or a stretch of ``span`` words wherever it begins, so that a template wrapped over lines is met
    as well. The stretches of a text of several lines come in pieces of twice the longest span, which overlap by it.

    Lines and pieces meet templates in a join on the prefix words. Of the pairs met, those stay whose block is long
    enough and whose remaining words after the first common one can still reach the threshold; then all words are
    compared, and those of each stretch where a piece has enough of them.
    """
    first = [r["word"] for r in index.select("word").distinct().collect()]
    starts = F.array(*map(F.lit, first))
    longest = index.agg(F.max("span")).first()[0] or 1
    n = F.size("sequence")
    pieces = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(n / longest).cast("int") - 2, F.lit(0))),
        lambda i: F.struct(F.slice("sequence", i * longest + 1, 2 * longest).alias("run"), F.lit(False).alias("line")),
    )
    lines = F.transform("lines", lambda words: F.struct(words.alias("run"), F.lit(True).alias("line")))
    blocks = (
        rows.filter(F.arrays_overlap(F.split(F.lower(text), BREAKS), starts))
        .select("key", F.transform(F.split(text, "\n"), words_of).alias("lines"))
        .select("key", "lines", F.flatten("lines").alias("sequence"))
        .select("key", F.explode(F.when(F.size("lines") > 1, F.concat(lines, pieces)).otherwise(lines)).alias("block"))
        .select("key", "block.run", "block.line", F.array_distinct("block.run").alias("have"))
    )
    met = (
        blocks.withColumn("word", F.explode(F.array_intersect("have", starts)))
        .join(F.broadcast(index), "word")
        .filter((F.size("have") >= F.col("least")) & (F.size("words") - F.col("place") >= F.col("least")))
    )
    shared = lambda words: F.size(F.array_intersect("words", words))
    stretches = F.sequence(F.lit(1), F.greatest(F.size("run") - F.col("span") + 1, F.lit(1)))
    closest = F.array_max(F.transform(stretches, lambda i: shared(F.slice("run", i, F.col("span")))))
    common = F.when(F.col("line") | (F.col("in_block") < F.col("least")), F.col("in_block")).otherwise(closest)
    return met.withColumn("in_block", shared(F.col("have"))).withColumn("common", common).filter("common >= least").select(
        "key", "label", (F.col("common") / F.size("words")).alias("containment")
    )


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates=TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """Per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``labels`` adds to those of the phrases the labels of every template that some line holds enough of, or some run of
    words, over line breaks, twice as long as the template (``score`` is the largest share of a template's words in
    one, 1.0 where a phrase stands, 0.0 without any finding).
    Null and empty texts have no words and no labels. Repeated rows get the same answer; ids may be null or repeat,
    as findings go back to rows by id and text hash. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.withColumn("key", F.struct("doc_id", F.xxhash64("text").alias("hash")))
    index = prefix_index(rows, templates, containment)
    found = (
        containing_blocks(rows, index)
        .groupBy("key")
        .agg(F.collect_set("label").alias("found"), F.max("containment").alias("containment"))
    )
    # Without the texts, both sides of the join are short rows.
    places = phrase_places(rows).drop("text")
    found = found.select(F.col("key.doc_id").alias("found_id"), F.col("key.hash").alias("found_hash"), "found", "containment")
    met = (F.col("doc_id").eqNullSafe(F.col("found_id"))) & (F.col("key.hash") == F.col("found_hash"))
    every = F.array_sort(F.array_union("base_found", F.coalesce("found", F.array().cast("array<string>"))))
    return places.join(keep(found), met, "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort(F.array_distinct("base_found")), ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
