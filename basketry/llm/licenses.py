"""License scans with a positional index of rare words.

The index lists, for every template, the positions of its words but for function words. A file's
licence words are weighed by their rarity over all documents, and all of them are looked up; postings that
agree on the relative position of file and template are added up. The best alignment's share of the
template's weight is its coverage. A template counts where coverage is high enough and every mandatory
key phrase stands in the file word for word. Only built-in functions run; what the driver holds is one
count for each word of the templates.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import keep

WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    """A licence notice: its label, its words, and phrases that must stand in a file."""
    label: str
    text: str
    phrases: tuple[str, ...]


# Fixed phrases and labels of the base scan.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Fixed wording of public licence notices.
TEMPLATES = (
    Template("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
             "provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the "
             "gnu general public license as published by the free software foundation",
             ("free software", "gnu general public license")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
             "hereby granted", ("with or without fee is hereby granted",)),
    Template("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
             "associated documentation files", ("permission is hereby granted free of charge",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license",)),
    Template("public-domain", "this is free and unencumbered software released into the public domain",
             ("released into the public domain",)),
)

# Words that the index leaves out: they stand in most texts and place nothing.
FUNCTION_WORDS = frozenset("a all and any are as by can for form in into is it of or that the this to under use v with "
                           "without you 0 2 3 4".split())
LEAST_COVERAGE = 0.6


def index_rows(templates: tuple[Template, ...] = TEMPLATES) -> list[tuple[int, int, str]]:
    """(template number, position, word) of all words but function words."""
    return [(t, i, w) for t, template in enumerate(templates) for i, w in enumerate(template.text.split())
            if w not in FUNCTION_WORDS]


def _anchor(phrase: str) -> tuple[str, int]:
    """The word by which a phrase is looked for, and its place: the first indexed word, else the first word."""
    words = phrase.split()
    at = next((i for i, w in enumerate(words) if w not in FUNCTION_WORDS), 0)
    return words[at], at



def _phrase_places(words: Column, hits: Column, phrase: str) -> Column:
    """Where a phrase starts, found by the hits of one of its words."""
    parts = phrase.split()
    anchor, at = _anchor(phrase)
    wanted = F.array(*[F.lit(w) for w in parts])
    return F.transform(F.filter(hits, lambda h: (h["word"] == anchor) & (h["pos"] >= at)
                                & (F.slice(words, F.greatest(h["pos"] - at, F.lit(0)) + 1, len(parts)) == wanted)),
                       lambda h: h["pos"] - at)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = TEMPLATES,
         base: dict[str, str] = BASE, least: float = LEAST_COVERAGE) -> DataFrame:
    """One row per document: key, n_words, n_base, first_word, last_word, base_labels, labels, score, matches.

    A null or empty text has no words, no labels and score 0. ``matches`` lists template label, first
    word and coverage. The score is 1 with a base phrase, else the best coverage of a matched template.
    Every licence word of a file is looked up, however many it holds. Repeated rows are scanned each;
    other columns are left out.
    """
    spark = docs.sparkSession
    index = index_rows(templates)
    phrases = sorted({*base, *(p for t in templates for p in t.phrases)})
    vocabulary = sorted({w for _, _, w in index} | {_anchor(p)[0] for p in phrases})

    split = F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))
    words = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), split.alias("words"))
    hits = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("pos"), w.alias("word"))),
                    lambda h: h["word"].isin(vocabulary))
    places = [F.when(F.size("hits") > 0, _phrase_places(F.col("words"), F.col("hits"), p)).alias(f"p{k}")
              for k, p in enumerate(phrases)]
    found = keep(words.withColumn("hits", hits).select("row", "key", F.size("words").cast("long").alias("n_words"),
                                                       "hits", *places))

    seen = found.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["word"]))).alias("word"))
    with_word = {r["word"]: r["n"] for r in seen.groupBy("word").agg(F.count("*").alias("n")).collect()}  # template words
    documents = found.count()
    rarity = {w: math.log((1 + documents) / (1 + with_word.get(w, 0))) + 1 for w in vocabulary}

    totals = {t: sum(rarity[w] for u, _, w in index if u == t) for t in range(len(templates))}
    postings = spark.createDataFrame([(t, i, w, rarity[w] / totals[t]) for t, i, w in index],
                                     "template int, at int, word string, share double")
    looked_up = found.select("row", F.explode("hits").alias("h"))
    aligned = looked_up.join(F.broadcast(postings), F.col("h.word") == postings["word"]).groupBy(
        "row", "template", (F.col("h.pos") - F.col("at")).alias("start")).agg(F.sum("share").alias("coverage"))
    best = aligned.where(F.col("coverage") >= least).groupBy("row", "template").agg(
        F.max(F.struct(F.round("coverage", 6).alias("coverage"), (-F.col("start")).alias("before"))).alias("best"))
    by_row = best.groupBy("row").agg(F.collect_list(F.struct(
        "template", (-F.col("best.before")).alias("start"), "best.coverage")).alias("aligned"))  # one for each template

    place_of = {p: F.col(f"p{k}") for k, p in enumerate(phrases)}
    present = {p: F.coalesce(F.size(c), F.lit(0)) > 0 for p, c in place_of.items()}
    verified = [reduce(lambda a, b: a & b, [present[p] for p in t.phrases]) for t in templates]
    joined = found.join(by_row, "row", "left")
    labels = F.array(*[F.lit(t.label) for t in templates])
    matches = F.array_sort(F.transform(
        F.filter(F.coalesce("aligned", F.array().cast("array<struct<template:int,start:int,coverage:double>>")),
                 lambda m: F.element_at(F.array(*verified), m["template"] + 1)),
        lambda m: F.struct(F.element_at(labels, m["template"] + 1).alias("label"), m["start"].alias("first_word"),
                           m["coverage"].alias("coverage"))))
    starts = F.concat(*[F.coalesce(place_of[p], F.array().cast("array<int>")) for p in base])
    base_labels = F.array_compact(F.array(*[F.when(present[p], F.lit(label)) for p, label in base.items()]))
    rows = joined.select("key", "n_words", starts.alias("starts"), base_labels.alias("base"), matches.alias("matches"))
    best_match = F.array_max(F.transform("matches", lambda m: m["coverage"]))
    return rows.select(
        F.col("key").alias(key), "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.transform("matches", lambda m: m["label"]))), ",").alias("labels"),
        F.when(F.size("starts") > 0, 1.0).otherwise(F.least(F.coalesce(best_match, F.lit(0.0)), F.lit(1.0))).alias("score"),
        "matches")
