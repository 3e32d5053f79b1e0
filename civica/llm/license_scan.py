"""License scans by a positional index of rare words; DataFrame functions only.

Each occurrence of a licence word of high inverse document frequency is looked up in the
templates' postings; position minus posting is where a template would begin. A beginning is
a match if enough of the template's words stand at their relative positions and its
mandatory phrases stand inside it. Of ``m`` words of which ``least`` must stand in place, any
``m - least + 1`` hold one that does, so only a template's rarest words have postings and
no beginning is missed, however many licence words a document holds. Rarity decides what is
looked up, never what matches: that rests on the template and the document alone.

Both passes only map documents. What is gathered is a count for each word of the
templates, whose number the templates bound.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civica.llm.common import ascii_lower

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that always give their label.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)


@dataclass(frozen=True)
class Template:
    """Words of a licence notice, and phrases that a match must hold."""

    label: str
    text: str
    phrases: tuple[str, ...]


# The opening words of widely used licence notices.
TEMPLATES = (
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the "
             "gnu general public license as published by the free software foundation", ("gnu general public license",)),
    Template("gpl-3", "licensed under the gnu general public license version 3",
             ("gnu general public license", "version 3")),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software "
             "foundation", ("gnu lesser general public license",)),
    Template("apache-2", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
             "associated documentation files the software to deal in the software without restriction",
             ("permission is hereby granted", "free of charge")),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
             "provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
             ("creative commons attribution",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee "
             "is hereby granted", ("permission to use copy modify",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software",)),
)

SHARE = 0.6  # of a template's words that must stand in place
SLACK = 2  # words that a phrase may lie beyond a template's ends


def text_words(text: Column) -> Column:
    parts = F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), SEPARATORS)
    return F.filter(parts, lambda w: w != "")


def document_counts(words: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """The number of documents, and in how many of them each of the given words stands."""
    held = words.select(F.explode_outer(F.array_intersect("words", F.lit(vocabulary))).alias("word"))
    found = {r["word"]: r["count"] for r in held.groupBy("word").count().collect()}
    return words.count(), {w: found.get(w, 0) for w in vocabulary}


def least_in_place(template: Template) -> int:
    """How many of a template's words must stand in place."""
    return math.ceil(SHARE * len(template.text.split()))


def posted_words(template: Template, counts: dict[str, int]) -> list[str]:
    """The rarest words of a template, so many that a match holds one of them in place.
    Words without a document stand nowhere, so they need no posting."""
    words = template.text.split()
    spare = len(words) - least_in_place(template) - sum(not counts[w] for w in words)
    chosen = []
    if spare < 0:  # too few of the words stand anywhere
        return chosen
    for w in sorted({w for w in words if counts[w]}, key=lambda w: (counts[w], w)):
        chosen.append(w)
        spare -= words.count(w)
        if spare < 0:
            break
    return chosen


def at(words: Column, place: Column) -> Column:
    """The word at a place; null outside."""
    return F.when(place >= 0, F.get(words, place))


def base_places(words: Column, phrases: tuple[tuple[str, str], ...]) -> Column:
    """``place, label`` wherever the words of a phrase stand consecutively."""

    def found(word: Column, place: Column) -> Column:
        result = F.lit(None).cast("struct<place:bigint,label:string>")
        for phrase, label in reversed(phrases):
            first, *rest = phrase.split()
            fits = word == first
            for k, other in enumerate(rest, 1):
                fits = fits & F.coalesce(F.get(words, place + k) == other, F.lit(False))
            result = F.when(fits, F.struct(place.cast("bigint").alias("place"), F.lit(label).alias("label"))).otherwise(result)
        return result

    return F.filter(F.transform(words, found), lambda x: x.isNotNull())


def scanned(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES,
            phrases: tuple[tuple[str, str], ...] = BASE_PHRASES) -> DataFrame:
    """Licence labels of every document.

    docs: ``doc_id, text``. Returns ``doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, matches``, a row for each row of docs. n_base counts the
    places of base phrases, first_word and last_word are the first and last of them (null
    without any). labels joins the labels of base phrases and of matched templates;
    matches lists the templates' beginnings (negative if the text starts inside one). score is 1 with a base phrase, else the best
    share of a matched template's words that stand in place, 0 without a match.

    Null texts count as empty: no words, empty labels, score 0. Null ids and repeated
    rows are kept. Texts are scanned whole. Other columns are not read.
    """
    words = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_words(F.col("text")).alias("words"))
    vocabulary = sorted({w for t in templates for w in t.text.split()})
    total, counts = document_counts(words, vocabulary)
    idf = {w: math.log((total + 1) / (counts[w] + 1)) for w in vocabulary}
    posted = [posted_words(t, counts) for t in templates]
    indexed = sorted({w for found in posted for w in found}, key=lambda w: (-idf[w], w))

    firsts = F.lit(sorted({phrase.split()[0] for phrase, _ in phrases}))
    none = F.array().cast("array<struct<place:bigint,label:string>>")
    rows = words.withColumn("base", F.when(F.arrays_overlap("words", firsts), base_places(F.col("words"), phrases)).otherwise(none))
    no_match = F.array().cast("array<struct<template:int,start:int,share:double,label:string>>")
    if indexed:
        # The index: for each word its templates and places; and each template's own row.
        index = F.create_map(*[x for word in indexed for x in (F.lit(word), F.array(*[
            F.struct(F.lit(t).alias("template"), F.lit(place).alias("place"))
            for t, found in enumerate(posted) if word in found
            for place, w in enumerate(templates[t].text.split()) if w == word]))])
        table = F.array(*[F.struct(
            F.lit(t.label).alias("label"), F.lit(t.text.split()).alias("words"),
            F.lit(least_in_place(t)).alias("least"), F.lit([f" {p} " for p in t.phrases]).alias("phrases")) for t in templates])
        rows = rows.withColumn("rare", F.array_intersect(F.lit(indexed), F.col("words")))
        placed = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("place"))),
                          lambda x: F.array_contains("rare", x["word"]))
        starts = F.array_distinct(F.flatten(F.transform(placed, lambda x: F.transform(
            index[x["word"]], lambda p: F.struct(p["template"].alias("template"), (x["place"] - p["place"]).alias("start"))))))
        text = F.col("words")

        def hits(x: Column, t: Column) -> Column:
            same = F.transform(t["words"], lambda w, i: F.coalesce(at(text, x["start"] + i) == w, F.lit(False)))
            return F.size(F.filter(same, lambda h: h))

        def holds(x: Column, t: Column) -> Column:
            begin = F.greatest(x["start"] - SLACK, F.lit(0))
            inside = F.slice(text, begin + 1, F.greatest(x["start"] + F.size(t["words"]) + SLACK - begin, F.lit(0)))
            joined = F.concat(F.lit(" "), F.array_join(inside, " "), F.lit(" "))
            return F.forall(t["phrases"], lambda p: F.contains(joined, p))

        def of(x: Column) -> Column:
            return F.get(table, x["template"])

        rows = rows.withColumn("starts", F.when(F.size("rare") > 0, F.filter(starts, lambda x: hits(x, of(x)) >= of(x)["least"])))
        kept = F.filter(F.coalesce("starts", F.array().cast("array<struct<template:int,start:int>>")),
                        lambda x: holds(x, of(x)))
        matches = F.transform(kept, lambda x: F.struct(
            x["template"].alias("template"), x["start"].alias("start"), (hits(x, of(x)) / F.size(of(x)["words"])).alias("share"),
            of(x)["label"].alias("label")))
        rows = rows.withColumn("matches", matches)
    else:
        rows = rows.withColumn("matches", no_match)
    places = F.transform("base", lambda x: x["place"])
    base = F.array_sort(F.array_distinct(F.transform("base", lambda x: x["label"])))
    every = F.array_sort(F.array_union(base, F.transform("matches", lambda x: x["label"])))
    best = F.coalesce(F.array_max(F.transform("matches", lambda x: x["share"])), F.lit(0.0))
    return rows.select(
        "doc_id", F.size("words").cast("bigint").alias("n_words"), F.size("base").cast("bigint").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(best).alias("score"), "matches")
