"""License notices: exact phrases, and an exact set-similarity join with templates.

A text block is a window of words that moves by half its length, over line ends as well,
so that a notice lies whole in a block however it is wrapped; half a window is as
long as the longest template. A block meets a template if it holds at least
``CONTAINMENT`` of the template's distinct words. Template words are ordered by their frequency in the
whole corpus, rarest first. A template of n words with a needed overlap of a has
the prefix of its n - a + 1 rarest words, one of which every matching block must
hold (prefix filter); a block with fewer than a words of the templates cannot match
(length filter); and when the rarest shared word stands at place p of the template
at most n - p words can be shared (positional filter). Blocks that pass meet
their templates through the prefix words and are verified by their overlap.

Everything is DataFrame functions. Only blocks that hold a template word at all
leave their row, as short arrays; the templates are a parameter of at most
``MAX_TEMPLATE_WORDS`` words, which bounds what is broadcast. Phrase places and
word counts are found in the row.

Defined results: a NULL or empty text has no words, no places and no labels, score
0; rows that repeat an id are judged one by one; ties of words in frequency are
ordered by the word; no templates leave the phrases only; a text of any length is cut
into its blocks in one pass; other columns of the table are not read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import NOT_WORD, WORD, let, null_safe_join, row_key
from kindred.sources.scratch import Scratch

CONTAINMENT = 0.8
MAX_TEMPLATE_WORDS = 10_000

#: Phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Notices as their licences recommend or contain them, and labels.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "released under the mit license"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "either version 3 of the license or at your option any later version"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
]


def needed(n: int, containment: float = CONTAINMENT) -> int:
    """Words a block must share with a template of ``n`` words."""
    return math.ceil(n * containment - 1e-9)


def stride(templates: list[tuple[str, str]]) -> int:
    """Words by which blocks move; a block has twice as many."""
    return max((len(text.split()) for _, text in templates), default=1)


def vocabulary(templates: list[tuple[str, str]]) -> list[str]:
    found = sorted({w for _, text in templates for w in text.split()})
    if len(found) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words are not broadcast")
    return found


def lowered(text: Column) -> Column:
    """Lower case for comparing ASCII words; the two other characters that would become ASCII letters are kept from it."""
    return F.lower(F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\u0130"), F.lit("\u0131")), F.lit("\u212a"), F.lit("\u0138")))


def extract(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    containment: float = CONTAINMENT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The one pass over the texts: ``id``, ``row``, ``n_words``, ``places`` ((label, word) of every phrase) and
    ``blocks``, the distinct template words, space-joined, of every block that holds enough of them to match any template."""
    vocab, step = vocabulary(templates), stride(templates)
    least = max(1, min((needed(len(set(t.split())), containment) for _, t in templates), default=1))
    known = (lambda w: w.isin(vocab)) if vocab else (lambda w: F.lit(False))
    rows = docs.select(F.col(doc_id).alias("id"), row_key(F.col(text)).alias("row"), lowered(F.col(text)).alias("lower"))

    # Half blocks: as many words as a block moves by, the last one may have fewer.
    halves = F.regexp_extract_all("lower", F.lit(f"(?:{WORD}(?:{NOT_WORD}+)?+){{1,{step}}}+"), 0)
    split = lambda half: F.split(half, NOT_WORD, -1)

    def of_halves(halves: Column) -> Column:
        # Only the ends of a split can be empty, here the last.
        last = let(split(F.element_at(halves, -1)), lambda p: F.size(p) - (F.element_at(p, -1) == "").cast("int"))
        n_words = F.when(F.size(halves) > 0, (F.size(halves) - 1) * step + last).otherwise(0).cast("long")
        held = F.transform(halves, lambda half: F.array_distinct(F.filter(split(half), known)))
        none = F.array().cast("array<string>")
        whole = lambda held: F.transform(held, lambda h, i: F.array_sort(F.array_union(h, F.coalesce(F.get(held, i + 1), none))))
        enough = F.filter(let(held, whole), lambda b: F.size(b) >= least)
        # As text, for texts are told apart by hash.
        return F.struct(n_words.alias("n_words"), F.array_distinct(F.transform(enough, lambda b: F.array_join(b, " "))).alias("blocks"))

    def labelled(phrase: str, label: str) -> Column:
        return F.transform(_places(F.col("lower"), phrase), lambda w: F.struct(F.lit(label).alias("label"), w.alias("word")))

    none = F.array().cast("array<struct<label:string,word:int>>")
    places = reduce(F.concat, [labelled(p, label) for p, label in phrases.items()], none)
    return rows.select("id", "row", let(halves, of_halves).alias("l"), places.alias("places")).select("id", "row", "l.*", "places")


def frequencies(blocks: DataFrame, vocab: list[str]) -> list[str]:
    """The template words, rarest in the blocks of the whole corpus first."""
    counted = blocks.select(F.explode("held").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    n = {r.w: r.n for r in counted.collect()}  # at most the template words
    return sorted(vocab, key=lambda w: (n.get(w, 0), w))


def similar(held: DataFrame, order: list[str], templates: list[tuple[str, str]], containment: float = CONTAINMENT) -> DataFrame:
    """Every (block, template) with containment of at least ``containment``: ``id``, ``row``, ``label``, ``containment``."""
    spark, rank = held.sparkSession, {w: i for i, w in enumerate(order)}
    rows = []
    for number, (label, text) in enumerate(templates):
        mine = sorted(set(text.split()), key=rank.get)
        least = needed(len(mine), containment)
        for place, w in enumerate(mine[: len(mine) - least + 1]):
            rows.append((w, number, label, place, least, mine))
    prefixes = spark.createDataFrame(rows, "word string, template int, label string, place int, least int, mine array<string>")
    met = held.select("*", F.explode("held").alias("word")).join(F.broadcast(prefixes), "word")
    # Length: enough words in the block. Position: enough words behind the shared one.
    met = met.filter((F.size("held") >= F.col("least")) & (F.size("mine") - F.col("place") >= F.col("least")))
    shared = F.size(F.array_intersect("held", "mine"))
    score = shared / F.size("mine")
    # Only at the rarest shared word, so that a pair is found once.
    first = F.filter("mine", lambda w: F.array_contains("held", w))[0] == F.col("word")
    return met.filter(first & (shared >= F.col("least"))).select("id", "row", "template", "label", score.alias("containment"))


def _places(lower: Column, phrase: str) -> Column:
    """Word numbers at which the phrase starts. Texts without one of its words are not taken apart."""
    norm = F.concat(F.lit(" "), F.regexp_replace(lower, NOT_WORD, " "), F.lit(" "))
    size = len(phrase.split())

    def starts(n: Column) -> Column:
        # The words before place i are those of the parts up to i, and i phrases.
        count = lambda t: F.size(F.filter(F.split(t, " ", -1), lambda w: w != ""))
        counts = F.transform(F.split(n, f"(?<= ){phrase}(?= )", -1), count)
        step = lambda a, c: F.concat(a, F.array(F.element_at(a, -1) + c + size))
        ends = lambda c: F.aggregate(F.slice(c, 2, F.size(c)), F.array(F.element_at(c, 1)), step)
        return let(let(counts, ends), lambda found: F.slice(found, 1, F.size(found) - 1))

    none = F.array().cast("array<int>")
    possible = reduce(lambda a, w: a & lower.contains(w), sorted(set(phrase.split()), key=len, reverse=True), F.lit(True))
    return F.when(possible, let(norm, lambda n: F.when(n.contains(f" {phrase} "), starts(n)).otherwise(none))).otherwise(none)


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score (1 for a phrase, else the largest containment)."""
    scratch = Scratch(docs.sparkSession, "licenses")
    base = scratch.save(extract(docs, phrases, templates, containment, doc_id, text), "extracted")
    held = base.select("id", "row", F.explode("blocks").alias("block")).select("id", "row", F.split("block", " ").alias("held"))
    order = frequencies(held, vocabulary(templates))
    pairs = similar(held, order, templates, containment)
    # At most the labels of the templates per document.
    found = pairs.groupBy("id", "row").agg(F.collect_set("label").alias("added"), F.max("containment").alias("best"))
    joined = null_safe_join(base, found, ["id", "row"], "left")
    base_labels = F.sort_array(F.array_distinct(F.transform("places", lambda p: p["label"])))
    none = F.array().cast("array<string>")
    any_place = F.size("places") > 0
    words_at = F.transform("places", lambda p: p["word"])
    return joined.select(
        "id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.when(any_place, F.array_min(words_at)).cast("long").alias("first_word"),
        F.when(any_place, F.array_max(words_at)).cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base_labels, F.coalesce("added", none))), ",").alias("labels"),
        F.when(any_place, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
