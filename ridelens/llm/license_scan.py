"""License scans with a positional index of rare licence words.

Method: all in DataFrame functions. One pass cuts each text into words and
keeps the positions of the words that licence templates use. The inverse
document frequencies of these words are counted over all documents. A file is
compared with the templates whose mandatory key phrases it holds: of each such
template, the rarest words that the file holds look up the postings (template,
offset), and each of their places says where the template would start. Only these
starts are verified: the template's words are sought at their relative positions,
``SLACK`` words early or late, so that a word put in or left out does not lose the
rest. A template has ``RARE`` look-up words, or as many more as it takes for the
rest of its words to weigh less than ``LEAST``, so no start that gives a label is
without one. A start's score is the share of the template's weight (the sum of its
words' inverse frequencies) that is found; a template whose best start reaches
``LEAST`` gives its label.

Base counts: every place where the words of a base phrase stand consecutively.

Distribution: rows are numbered when the pass is written, and later steps join
and group by that number, one file each. The templates, their postings and the
frequencies of their words are bounded by the template list.

Edge cases: null and empty texts have no words, no places and no labels, and a
score of 0; repeated rows are scanned each; a null doc_id is kept; an empty
table gives an empty table; other columns are ignored."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelens.llm.shared import id_and_text, materialise

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RARE, LEAST = 6, 0.6
#: Words that a template's word may stand before or after its place.
SLACK = 3

# Phrases and labels of the contract.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: label, template, mandatory key phrase; several templates may share a label.
TEMPLATES = [
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "permission is hereby granted free of charge"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation", "gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "redistribution and use in source and binary forms"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
     "software the software is provided as is without warranty of any kind express or implied", "permission notice shall be included"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at",
     "you may not use this file except in compliance with the license"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
     "merchantability or fitness for a particular purpose see the gnu general public license for more details",
     "see the gnu general public license for more details"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
     "redistributions in binary form must reproduce the above copyright notice", "redistributions of source code must retain"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided "
     "that the above copyright notice and this permission notice appear in all copies", "permission to use copy modify and or distribute"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
]


def words_of(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), F.lit(WORD), F.lit(0))


def places(phrase: str) -> Column:
    """Where the words of the phrase stand consecutively, from ``hits``."""

    def at(k: int, word: str) -> Column:
        own = F.filter("hits", lambda x: x["word"] == word)
        return F.transform(own, lambda x: x["pos"] - k)

    each = [at(k, word) for k, word in enumerate(phrase.split())]
    # most files lack the phrase's words and need no look at their places
    there = reduce(lambda a, b: a & b, (F.array_contains("vocabulary", w) for w in dict.fromkeys(phrase.split())))
    return F.when(there, reduce(F.array_intersect, each)).otherwise(F.array().cast("array<int>"))


def look_ups(template: str, idf: dict[str, float]) -> Column:
    """The rarest words of the template that the file holds, from ``vocabulary``."""
    words = template.split()
    ordered = sorted(set(words), key=lambda w: (-idf[w], w))
    least = LEAST * sum(idf[w] for w in words)
    many = next(n for n in range(len(ordered) + 1) if sum(idf[w] for w in words if w not in ordered[:n]) < least)
    held = F.filter(F.array(*map(F.lit, ordered)), lambda w: F.array_contains("vocabulary", w))
    return F.slice(held, 1, max(RARE, many))


def scan(docs: DataFrame, templates: list[tuple[str, str, str]] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and
    score of every row of ``docs``."""
    phrases = [*BASE, *(p for _, text, key in templates for p in (text, key))]
    licence_words = sorted({w for p in phrases for w in p.split()})
    words = id_and_text(docs).select("doc_id", words_of(F.col("text")).alias("words"))
    numbered = F.transform("words", lambda w, i: F.struct(i.alias("pos"), w.alias("word")))
    hits = F.filter(numbered, lambda x: x["word"].isin(licence_words))
    table = words.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("long").alias("n_words"), hits.alias("hits"))
    table = materialise(table, "licence-words")
    table = table.withColumn("vocabulary", F.array_distinct(F.transform("hits", lambda x: x["word"])))

    counts = table.select(F.explode("vocabulary").alias("word")).groupBy("word").count().collect()  # licence words at most
    total = table.count()
    seen = {r.word: r["count"] for r in counts}
    idf = {w: math.log((total + 1) / (seen.get(w, 0) + 0.5)) + 1e-6 for w in licence_words}

    found = [places(p) for p in BASE]
    base = table.select(
        "row", "doc_id", "n_words", "hits", "vocabulary",
        F.array(*(F.size(x) for x in found)).alias("sizes"), F.concat(*found).alias("starts"),
        F.filter(F.array(*(F.when(F.size(places(key)) > 0, F.lit(t)) for t, (_, _, key) in enumerate(templates))),
                 lambda x: x.isNotNull()).alias("allowed"),
    )
    base = materialise(base.withColumn("hits", F.when(F.size("allowed") > 0, F.col("hits"))), "licence-places")

    spark = docs.sparkSession
    rows = [
        (t, label, k, w, idf[w], sum(idf[x] for x in text.split()))
        for t, (label, text, _) in enumerate(templates)
        for k, w in enumerate(text.split())
    ]
    postings = spark.createDataFrame(rows, "template int, label string, offset int, word string, weight double, total double")

    rare = F.array(*(F.when(F.array_contains("allowed", t), look_ups(text, idf)) for t, (_, text, _) in enumerate(templates)))
    files = base.where(F.size("allowed") > 0).select("row", "hits", "allowed", rare.alias("rare"))
    known = F.broadcast(postings)  # the words of the templates
    # the rare words' places look up the postings: where a template would start
    asked = F.filter("hits", lambda x: F.exists("rare", lambda own: F.coalesce(F.array_contains(own, x["word"]), F.lit(False))))
    looked = files.select("row", "allowed", "rare", F.explode(asked).alias("hit")).select("row", "allowed", "rare", "hit.*").join(known, "word")
    looked = looked.where(F.array_contains("allowed", F.col("template")) & F.array_contains(F.element_at("rare", F.col("template") + 1), F.col("word")))
    starts = looked.select("row", "template", (F.col("pos") - F.col("offset")).alias("start")).distinct()
    # the words of the file that these templates have, at about their places
    hit = files.select("row", "allowed", F.explode("hits").alias("hit")).select("row", "allowed", "hit.*")
    met = hit.join(known, "word").where(F.array_contains("allowed", F.col("template")))
    about = F.explode(F.sequence(F.col("pos") - F.col("offset") - SLACK, F.col("pos") - F.col("offset") + SLACK))
    met = met.select("row", "template", "label", "total", "offset", "weight", about.alias("start"))
    met = met.join(starts, ["row", "template", "start"], "left_semi").distinct()  # a template's word counts once
    aligned = met.groupBy("row", "template", "label", "total", "start").agg(F.sum("weight").alias("weight"))
    scored = aligned.select("row", "label", F.round(F.col("weight") / F.col("total"), 9).alias("score")).groupBy("row").agg(
        F.max("score").alias("score"), F.collect_set(F.when(F.col("score") >= LEAST, F.col("label"))).alias("own")
    )

    base_labels = F.filter(
        F.array(*(F.when(F.col("sizes")[k] > 0, F.lit(label)) for k, label in enumerate(BASE.values()))), lambda x: x.isNotNull()
    )
    out = base.drop("hits", "vocabulary", "allowed").join(scored, "row", "left").withColumn("base", base_labels)
    joined = F.array_union("base", F.coalesce("own", F.array().cast("array<string>")))
    return out.select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(joined), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
