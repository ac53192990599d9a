"""License scan: phrases word by word, and an exact set-similarity join of text blocks with license notices.

Words are runs of ASCII letters (A-Z lower-cased), ASCII digits and all other non-ASCII characters. A text is cut
into halves of as many words as the longest notice has, and a block is two halves in
turn, so every stretch of a notice's length stands in one block whole. A block meets
the threshold with a notice when it holds at least ``num / den`` of the notice's
distinct words (containment).

The join is exact. All words of all notices are put in one order, rarest in the corpus
first (counted over the halves of every text; ties by the word). Prefix filter: a notice of
n words of which ``c`` must be met cannot miss all of its first n - c + 1, so only these
are joined, with the words of the blocks. Length filter: a block has at least c words of any notice.
Positional filter: after the first common word, at place i of the notice and j of
the block, no more than the shorter rest can follow. What is left is verified by the
intersection itself. A pair comes up once, under its first common word.

Everything is DataFrame expressions. The texts are read and cut once, into a table below
the shared folder; blocks are rows of at most two halves, and a group by row collects
what one text holds, so its size is bounded by that text. Notices and phrases are
parameters; their words are counted by Spark and their order (one row a word) is
made on the driver.

Defined results: null, empty and wordless texts have no words, places, matches or
labels and score 0. Rows are judged one by one, whatever ids repeat or are null. An
empty table gives no rows; other columns are not read, whatever they are called.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointframe.llm.common import ascii_lower, materialize, pick, sized

# fixed values: what stands between words; phrases; public license notices and their labels
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
NOTICES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
            "as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

POSTINGS = "array<struct<word: string, notice: int, label: string, i: int, n: int, c: int, prefix: array<string>, words: array<string>>>"


def text_words(text: str) -> list[str]:
    """The words of a Python string, as ``license_words`` has them."""
    return [w for w in re.split(BETWEEN, re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]


def license_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN, -1), "")


def needed(n: int, num: int, den: int) -> int:
    return -(-n * num // den)


def stride(notices) -> int:
    return max((len(text_words(t)) for _, t in notices), default=1)


def _starts(ws: list[str], label: str) -> Column:
    """Where the words ``ws`` stand in turn in the column ``w``: array of (start, label)."""
    def here(w: Column, i: Column) -> Column:
        hit = w == ws[0]
        for k, x in enumerate(ws[1:], 1):
            hit = hit & F.get("w", i + k).eqNullSafe(F.lit(x))
        return F.when(hit, F.struct(i.cast("long").alias("start"), F.lit(label).alias("label")))

    return F.when(F.array_contains("w", ws[-1]), F.filter(F.transform("w", here), lambda x: x.isNotNull()))


def _places(phrases) -> Column:
    none = F.array().cast("array<struct<start: long, label: string>>")
    return F.array_sort(F.flatten(F.array_compact(F.array(none, *[_starts(text_words(p), label) for p, label in phrases]))))


def cut_texts(docs: DataFrame, id: str, text: str, phrases, vocabulary: list[str], size: int) -> DataFrame:
    """Per row: row (its number), id, n_words, places, and halves, the distinct vocabulary words of every ``size`` words."""
    w = pick(docs, id=id, text=text).select("id", license_words(F.col("text")).alias("w"))
    n = F.size("w")
    halves = F.transform(F.sequence(F.lit(0), F.ceil(n / size).cast("int") - 1), lambda k: F.array_distinct(
        F.filter(F.slice("w", k * size + 1, F.lit(size)), lambda x: x.isin(vocabulary))))
    rows = w.select(F.monotonically_increasing_id().alias("row"), "id", n.cast("long").alias("n_words"), _places(phrases).alias("places"),
                    F.when(n > 0, halves).otherwise(F.array().cast("array<array<string>>")).alias("halves"))
    return materialize(rows, "cut")


def similar_blocks(cut: DataFrame, notices, num: int, den: int, size: int) -> DataFrame:
    """row, block, label, notice (its number), shared and containment of every block that meets the threshold with a notice."""
    spark = cut.sparkSession
    counts = cut.select(F.explode(F.flatten("halves")).alias("word")).groupBy("word").count()
    often = {r["word"]: r["count"] for r in counts.collect()}  # at most one row for each word of the notices
    sets = [sorted(set(text_words(t)), key=lambda x: (often.get(x, 0), x)) for _, t in notices]
    order = sorted({x for s in sets for x in s}, key=lambda x: (often.get(x, 0), x))
    posts = []
    for k, ((label, _), s) in enumerate(zip(notices, sets, strict=True)):
        c = needed(len(s), num, den)
        prefix = s[:len(s) - c + 1]
        posts += [{"word": x, "notice": k, "label": label, "i": i, "n": len(s), "c": c, "prefix": prefix, "words": s} for i, x in enumerate(prefix)]
    postings = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(posts)), POSTINGS)))
    first = sorted({p["word"] for p in posts})

    blocks = cut.where(F.size("halves") > 0).select("row", F.explode(F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("halves") - 2)),
        lambda k: F.struct(k.alias("block"), F.array_union(F.get("halves", k), F.coalesce(F.get("halves", k + 1), F.array().cast("array<string>"))).alias("held")))).alias("b"))
    blocks = blocks.select("row", "b.block", "b.held")
    met = blocks.select("row", "block", "held", F.explode(F.filter("held", lambda x: x.isin(first))).alias("word"))
    # broadcast: as many rows as the notices have prefix words
    pairs = met.join(F.broadcast(postings), "word").where(F.size("held") >= F.col("c"))
    pairs = pairs.where(F.get(F.array_intersect("prefix", "held"), F.lit(0)) == F.col("word"))
    laid = F.filter(F.array(*[F.lit(x) for x in order]).cast("array<string>"), lambda x: F.array_contains("held", x))
    rest = F.least(F.col("n") - F.col("i"), F.size("held") - F.array_position(laid, F.col("word")).cast("int") + 1)
    pairs = pairs.where(rest >= F.col("c")).withColumn("shared", F.size(F.array_intersect("words", "held")))
    return pairs.where("shared >= c").select("row", "block", "label", "notice", "shared", (F.col("shared") / F.col("n")).alias("containment"))


def scan_licenses(docs: DataFrame, id: str = "doc_id", text: str = "text", *, phrases=PHRASES, notices=NOTICES, num: int = 90, den: int = 100) -> DataFrame:
    """Per row: id, n_words, places (start, label of every phrase), matches (first_word, end_word, label, containment of
    every block that meets the threshold), base_labels, labels (arrays, sorted) and score: the greatest containment, 1 with a phrase."""
    size = stride(notices)
    vocabulary = sorted({x for _, t in notices for x in text_words(t)})
    cut = cut_texts(docs, id, text, phrases, vocabulary, size)
    found = similar_blocks(cut, notices, num, den, size).groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        (F.col("block") * F.lit(size)).cast("long").alias("first_word"), ((F.col("block") + 2) * F.lit(size)).cast("long").alias("end_word"),
        "label", "containment"))).alias("matches"))
    found = sized(materialize(found, "found"), 100_000)
    rows = cut.drop("halves").join(found, "row", "left").withColumn("matches", F.transform(
        F.coalesce("matches", F.array().cast(found.schema["matches"].dataType)),
        lambda m: m.withField("end_word", F.least(m["end_word"], F.col("n_words")))))
    base, own = F.col("places")["label"], F.col("matches")["label"]
    score = F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.col("matches")["containment"]), F.lit(0.0)))
    return rows.select("id", "n_words", "places", "matches", F.array_sort(F.array_distinct(base)).alias("base_labels"),
                       F.array_sort(F.array_union(base, own)).alias("labels"), score.alias("score"))


def licensed(docs: DataFrame, labels: list[str], id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """id and labels of the rows that carry one of ``labels``."""
    return scan_licenses(docs, id, text, **options).where(F.arrays_overlap("labels", F.array(*[F.lit(x) for x in labels]))).select("id", "labels")
