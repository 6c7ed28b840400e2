"""Licence scan by a positional index of rare words, in DataFrame operations only.

The index lists, for every rare word of the licence templates, the templates and positions it stands
at. A file looks up all the rare words it holds; every hit votes for a template and an offset (place
in the file less place in the template). Hits that agree on an offset are counted, and a template is
reported when enough of its rare words agree and its mandatory key phrases are in the file.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm.graph import keep

# fixed values: labels, notices of well-known licences, and phrases a notice must hold
TEMPLATES: list[tuple[str, str, list[str]]] = [
    ("mit", "Released under the MIT License.", ["mit license"]),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction",
        ["hereby granted free of charge", "without restriction"],
    ),
    ("apache", "Licensed under the Apache License, Version 2.0.", ["apache license version 2 0"]),
    (
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        ["in compliance with the license"],
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
        ["gnu general public license"],
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
        ["lesser general public license"],
    ),
    (
        "agpl",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published "
        "by the Free Software Foundation",
        ["affero general public license"],
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        ["redistribution and use in source and binary forms"],
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ["mozilla public license"],
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        ["with or without fee is hereby granted"],
    ),
    (
        "cc-by",
        "licensed under a Creative Commons Attribution 4.0 International License",
        ["creative commons attribution"],
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain",
        ["unencumbered software released into the public domain"],
    ),
]
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
COMMON_IN = 0.34  # a word in more than this share of the templates is no rare word

_APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _template_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def build_index() -> tuple[list[str], list[tuple[str, int, int]], list[int]]:
    """Rare words by falling IDF, postings ``(word, template, position)``, postings per template."""
    cut = [_template_words(t) for _, t, _ in TEMPLATES]
    holds: dict[str, set[int]] = defaultdict(set)
    for number, words in enumerate(cut):
        for word in words:
            holds[word].add(number)
    idf = {w: math.log(len(cut) / len(t)) for w, t in holds.items() if len(w) > 2 and len(t) <= COMMON_IN * len(cut)}
    for word in ("the", "and", "for", "with", "any", "you", "may", "not", "can", "are", "that", "this", "use"):
        idf.pop(word, None)
    rare = sorted(idf, key=lambda w: (-idf[w], w))
    postings = [(w, n, i) for n, words in enumerate(cut) for i, w in enumerate(words) if w in idf]
    return rare, postings, [sum(1 for p in postings if p[1] == n) for n in range(len(cut))]


def _places(words: str, phrase: str) -> Column:
    """Starts of the places where the phrase's words stand one after another."""
    parts = phrase.split()
    last = len(parts) - 1
    ends = F.filter(F.transform(words, lambda w, i: F.when(w == parts[-1], i).otherwise(F.lit(-1))), lambda i: i >= last)
    here = F.filter(
        ends,
        lambda i: F.forall(
            F.array(*[F.get(F.col(words), i - last + k) == part for k, part in enumerate(parts[:-1])]), lambda x: x
        ),
    )
    return F.transform(here, lambda i: i - last)


def license_scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Licence places, labels and score for every row of ``docs(doc_id, text, ...)``.

    Words are runs of ASCII letters, digits and characters outside ASCII, A-Z lower-cased.
    ``n_base``, ``first_word``, ``last_word``: count, smallest and largest start of the places of the
    base phrases (null without one); ``base_labels``: their labels; ``labels``: those and the labels
    of templates found; ``score``: the largest share of a found template's rare words that agree on
    one offset, at least 0.5 with a base phrase, else 0. Labels are distinct, sorted, comma-joined.

    Null and empty texts have no words and no labels. Rows that repeat, have a null ``doc_id`` or
    carry other columns are judged one by one; equal ``doc_id`` and text share one look-up. Texts are
    cut into words once and scanned whole, however long; the words of files with a rare licence word are
    stored, so that key phrases are looked for only where postings agree. The index is fixed by the
    templates, so its size does not grow with the data.
    """
    rare, postings, totals = build_index()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # the Kelvin sign is the only other character that lower-casing turns into a letter of a licence word
    low = F.lower(F.replace("text", F.lit("\u212a"), F.lit("\u0138")))
    cut = F.array_remove(F.split(low, _APART), "")
    # a generator's output is computed once, however many expressions below read it
    files = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.octet_length("text").alias("size"), F.explode(F.array(cut)).alias("words"))

    none = F.array().cast("array<int>")
    ends = F.array_contains("words", F.lit("license"))  # the last word of every base phrase
    places = {phrase: F.when(ends, _places("words", phrase)).otherwise(none) for phrase in BASE}
    spoken = files.select(
        "doc_id", "text_hash", "size", F.size("words").cast("long").alias("n_words"), "words",
        F.explode(F.array(F.struct(*[places[p].alias(label) for p, label in BASE.items()]))).alias("at"),
        F.array_intersect(F.array(*map(F.lit, rare)), F.col("words")).alias("look"),
    )
    scanned = keep(
        spark,
        spoken.select(
            "doc_id", "text_hash", "size", "n_words", F.concat(*[F.col(f"at.{label}") for label in BASE.values()]).alias("starts"),
            F.array_sort(F.array_compact(F.array(*[F.when(F.size(f"at.{label}") > 0, F.lit(label)) for label in BASE.values()]))).alias("base"),
            "look", F.when(F.size("look") > 0, F.col("words")).alias("words"),
        ),
        "scanned",
    )

    marked = [(word, number, place, 1 << place) for word, number, place in postings]  # templates are short
    index = spark.createDataFrame(marked, "word string, template int, place int, bit long")
    key = ["doc_id", "text_hash", "size"]
    total, name = F.array(*map(F.lit, totals)), F.array(*[F.lit(label) for label, _, _ in TEMPLATES])
    holding = scanned.where("words is not null")
    agreed = (
        holding.select(*key, "look", F.posexplode("words").alias("at", "word"))
        .where(F.array_contains("look", F.col("word")))
        .join(F.broadcast(index), "word")  # as large as the templates, whatever the data
        .groupBy(*key, "template", (F.col("at") - F.col("place")).alias("offset"))
        .agg(F.bit_count(F.bit_or("bit")).alias("agree"))
        .groupBy(*key, "template")
        .agg(F.max(F.col("agree") / F.get(total, F.col("template"))).alias("share"))
        .where("share >= 0.6")
        .groupBy(*key)
        .agg(F.collect_list(F.struct("template", "share")).alias("agreed"))
    )
    joined = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    said = [F.forall(F.array(*[F.contains(F.col("told"), F.lit(f" {phrase} ")) for phrase in keys]), lambda x: x) for _, _, keys in TEMPLATES]

    def same(left: str, right: str) -> list[Column]:
        return [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in key]

    once = holding.alias("h").join(agreed.alias("a"), same("h", "a")).select("h.doc_id", "h.text_hash", "h.size", "agreed", F.explode(F.array(joined)).alias("told"))
    once = once.dropDuplicates(key)
    verified = once.select(*key, F.explode(F.filter("agreed", lambda t: F.get(F.array(*said), t["template"]))).alias("t"))
    found = verified.groupBy(*key).agg(F.max("t.share").alias("share"), F.collect_set(F.get(name, F.col("t.template"))).alias("more"))
    nothing = F.array().cast("array<string>")
    return scanned.alias("s").join(found.alias("f"), same("s", "f"), "left").select(
        "s.doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_join(F.array_distinct("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", nothing))), ",").alias("labels"),
        F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.size("starts") > 0, 0.5).otherwise(0.0)).alias("score"),
    )
