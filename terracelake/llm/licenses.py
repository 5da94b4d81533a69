"""Finds licence notices: phrases word by word, and whole notices by set containment."""

from __future__ import annotations

import re
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terracelake.llm.common import prepare, store, text_of

# A phrase's words stand consecutively; label.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Clauses of public licence notices; label. A notice of several lines is
# given clause by clause.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may obtain a copy of the License at http www apache org licenses LICENSE 2 0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "You should have received a copy of the GNU General Public License along with this program"),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("lgpl", "You should have received a copy of the GNU Lesser General Public License along with this library"),
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("agpl", "You should have received a copy of the GNU Affero General Public License along with this program"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

# Words that make a licence another one. A block may not have them unless the template does.
MODIFIERS = ("lesser", "affero", "nc", "noncommercial", "sa", "sharealike", "nd", "noderivatives")
# Other names. A block has to have all names and modifiers of the template.
NAMES = ("mit", "apache", "gnu", "mozilla", "eclipse", "creative", "commons", "cc", *MODIFIERS)
# A template of fewer words has to be there whole.
SHORT = 10

# ASCII characters that are in no word once A-Z are lower-cased.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same before that.
BREAKS_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z lower-cased. Two other letters have lower-case forms with ASCII in them and are put out of the way."""
    return F.lower(F.replace(F.replace(text, F.lit("\u0130"), F.lit("\u0131")), F.lit("\u212a"), F.lit("\u0138")))


def spaced(phrase: str) -> str:
    return " " + phrase.replace(" ", "  ") + " "


def words_of(text: Column) -> Column:
    """The words in their order; an empty one may come before and after them."""
    return F.split(lowered(text), BREAKS)


def tokens_of(notice: str) -> list[str]:
    return re.sub(BREAKS, " ", notice.lower()).split()


def required(notice: str, threshold: float) -> int:
    """Distinct words of a notice that a block has to hold."""
    n = len(set(tokens_of(notice)))
    return n if n < SHORT else ceil(n * threshold)


def width(notice: str, threshold: float) -> int:
    """Words of a block: the notice's own and as many others as leave it ``threshold`` of the block."""
    words = tokens_of(notice)
    return len(words) if len(set(words)) < SHORT else ceil(len(words) / threshold)


def prefixes(docs: DataFrame, threshold: float) -> DataFrame:
    """The words of each template by which blocks are found, in the order of the corpus's word frequencies.

    token, label, tokens (of the template, rarest first), names, others (modifiers it lacks), required, width, later (its tokens
    that aren't rarer than this one). A template with names is found by its rarest name, since a block needs all of
    them; another by its rarest words, of which a block has one. All of it is made of TEMPLATES, so it is of fixed size.
    """
    spark = docs.sparkSession
    rows = []
    for i, (label, notice) in enumerate(TEMPLATES):
        own = sorted(set(tokens_of(notice)))
        rows.append((i, label, own, [w for w in own if w in NAMES], [w for w in MODIFIERS if w not in own],
                     required(notice, threshold), width(notice, threshold)))
    templates = spark.createDataFrame(rows, "template int, label string, tokens array<string>, names array<string>, "
                                            "others array<string>, required int, width int")
    vocabulary = F.broadcast(templates.select(F.explode("tokens").alias("token")).distinct())
    counts = docs.select(F.explode(words_of(text_of())).alias("token")).join(vocabulary, "token").groupBy("token").agg(
        F.count(F.lit(1)).alias("n"))
    counts = store(counts, "token_counts")
    each = templates.select("*", F.explode("tokens").alias("token")).join(counts, "token", "left").fillna(0, ["n"])
    ranked = Window.partitionBy("template").orderBy("n", "token")
    named = F.array_contains("names", F.col("token"))
    whole = Window.partitionBy("template").orderBy("n", "token").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    first_name = F.row_number().over(Window.partitionBy("template", named).orderBy("n", "token"))
    return (
        each.select("*", F.row_number().over(ranked).alias("place"), F.collect_list("token").over(whole).alias("later"),
                    (named & (first_name == 1)).alias("first_name"))
        .filter(F.when(F.size("names") > 0, F.col("first_name")).otherwise(F.col("place") <= F.size("tokens") - F.col("required") + 1))
        .select("token", "label", "tokens", "names", "others", "required", "width", "later"))


def spans(texts: DataFrame, found_by: DataFrame) -> DataFrame:
    """id, print, label, tokens, names, others, required, width, span, first: each place of a prefix word, with the words from the
    first to the last block around it, if they hold enough of the template. first: the span's last start of a block.

    The longest work is here, in one pass: words are exploded by place and joined to the prefixes by hash,
    and only around a match a span is cut. A text's length doesn't matter to the cost of a word.
    """
    words = texts.select("id", "print", words_of(text_of()).alias("words"))
    begin = F.greatest(F.lit(0), F.col("at") - F.col("width") + 1)
    return (
        words.select("id", "print", "words", F.posexplode("words").alias("at", "token"))
        .join(F.broadcast(found_by), "token")
        .select("id", "print", "label", "tokens", "names", "others", "required", "width", "later",
                F.slice("words", begin + 1, F.col("at") - begin + F.col("width")).alias("span"), (F.col("at") - begin).alias("last"))
        # Length and positional filters: enough distinct words, and enough of them not rarer than the prefix word.
        .filter(F.size("span") >= F.col("required"))
        .filter(F.size(F.array_intersect("span", "tokens")) >= F.col("required"))
        .filter((F.size("names") > 0) | (F.size(F.array_intersect("span", "later")) >= F.col("required")))
        .drop("later"))


def notices(texts: DataFrame, threshold: float) -> DataFrame:
    """id, print, label, share of the templates that stand in a block. A block is any ``width`` words in a row."""
    found = store(spans(texts, store(prefixes(texts, threshold), "prefixes")), "spans")
    blocks = F.transform(F.sequence(F.lit(0), F.col("last")), lambda i: F.slice("span", i + 1, F.col("width")))
    shared = F.transform(blocks, lambda block: F.when(
        (F.size(F.array_intersect(block, "names")) == F.size("names")) & ~F.arrays_overlap(block, "others"),
        F.size(F.array_intersect(block, "tokens"))).otherwise(F.lit(0)))
    return (
        found.select("id", "print", "label", "tokens", "required", F.array_max(shared).alias("shared"))
        .filter(F.col("shared") >= F.col("required"))
        .select("id", "print", "label", (F.col("shared") / F.size("tokens")).alias("share")))


def scan_licenses(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Licence phrases and notices of every text.

    doc_id, n_words, n_base (places of all phrases), first_word and last_word (smallest and
    largest start of a phrase, words from 0), base_labels, labels (with those of notices),
    score: the largest share of a template's words that one block holds, 0 if no template fits, and 1
    where a phrase stands.

    A block is any run of words as long as the template, and a quarter longer at the usual threshold,
    whatever lines it is in. A template fits if a block holds ``threshold`` of its distinct words (all, of a
    template of fewer than SHORT), every one of its NAMES, and none of the MODIFIERS that it lacks: so a
    notice of the Lesser licence is not one of the GPL, though it holds nearly all its words. Labels of
    phrases stand beside those of templates, as "gpl" does for every "General Public License".

    Templates are joined to blocks exactly: tokens are ordered by their frequency in the corpus, a
    template's rarest ones are its prefix, and only runs around a token of it are candidates. A candidate is dropped if it
    has too few words (length filter), or too few that are not rarer than the matching one (positional
    filter), before its blocks are compared. Only the prefixes, whose size TEMPLATES fixes, are broadcast.

    A null text is empty and has no words. Null doc_ids are kept; rows with the same doc_id
    each have their own result, equal rows equal ones. An empty table gives no rows. Other
    columns are not read.
    """
    prepare(docs.sparkSession)
    texts = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("id"),
                        F.xxhash64(text_of()).alias("print"), "text")
    found = notices(texts, threshold).groupBy("id", "print").agg(
        F.collect_set("label").alias("notice_labels"), F.max("share").alias("share"))

    parts = F.split(text_of(), BREAKS_ANY_CASE)  # the first and the last may be empty
    n_words = F.size("parts") - F.when(F.get("parts", F.lit(0)) == "", 1).otherwise(0) - F.when(
        (F.size("parts") > 1) & (F.element_at("parts", -1) == ""), 1).otherwise(0)
    words = F.concat(F.lit(" "), F.regexp_replace(lowered(text_of()), BREAKS, "  "), F.lit(" "))
    # Words stand between two spaces each, so phrases that follow one another share none.
    likely = F.contains(F.lower(text_of()), F.lit("license"))
    base = texts.select("*", parts.alias("parts")).select(
        "doc_id", "id", "print", n_words.cast("long").alias("n_words"), F.when(likely, words).alias("words"))
    count = [F.coalesce((F.length("words") - F.length(F.replace("words", F.lit(spaced(p))))) / len(spaced(p)), F.lit(0)).cast("long")
             for p in PHRASES]
    first = [F.when(n > 0, F.regexp_count(F.substring_index("words", spaced(p), 1), F.lit("[^ ]+"))) for p, n in zip(PHRASES, count)]
    last = [F.when(n > 0, F.col("n_words") - F.regexp_count(F.substring_index("words", spaced(p), -1), F.lit("[^ ]+")) - len(p.split()))
            for p, n in zip(PHRASES, count)]
    labels = F.array(*(F.when(n > 0, F.lit(label)) for n, label in zip(count, PHRASES.values())))
    base = base.select(
        "doc_id", "id", "print", "n_words", sum(count[1:], count[0]).alias("n_base"),
        F.least(*first).cast("long").alias("first_word"), F.greatest(*last).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(labels))).alias("base"))
    return base.join(store(found, "notices"), ["id", "print"], "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", F.coalesce("notice_labels", F.array())))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
