"""License scan with a positional index of rare words, as DataFrame operations only.

1. Words of all files are counted by the files that hold them, for the words of the templates.
2. The index keeps, per template, its words of highest IDF with their positions.
3. Each file looks up every indexed word that it holds. A word at place ``p`` of the file and ``q`` of a template
   votes for the alignment ``p - q``; alignments that hold a set share of the template's indexed words, together with
   those a few words off, stay.
4. An alignment counts if each mandatory phrase of the template stands at its place, give or take a few words.

Base labels come from fixed phrases wherever they stand and need no template.

Defined results: a NULL or empty text has no words, no places and empty labels; ties of IDF follow the word; repeated rows
each get a row; an empty table gives no rows; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

# Public licence passages and the phrases that a match must hold.
TEMPLATES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        ("permission is hereby granted free of charge", "to deal in the software without restriction"),
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        ("for any purpose with or without fee", "is hereby granted provided that"),
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
        ("redistribution and use in source and binary forms", "must retain the above copyright notice"),
    ),
    "apache": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS",
        ("except in compliance with the license", "unless required by applicable law"),
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
        ("under the terms of the gnu general public license", "published by the free software foundation"),
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
        ("gnu lesser general public license", "published by the free software foundation"),
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        ("mozilla public license", "if a copy of the mpl was not distributed"),
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software",
        ("free and unencumbered software released into the public domain",),
    ),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
}
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class ScanSettings:
    """``template_words``: indexed words per template at most, and never more than half of its words (but three).
    ``min_share``: share of indexed words an alignment must hold. ``slack``: words by which indexed words and phrases may be off
    their places."""

    template_words: int = 12
    min_share: float = 0.5
    slack: int = 4


def words_of(text: Column) -> Column:
    """Words of a text with A-Z in lower case.

    ``lower`` also folds other letters, which moves no word border; the Kelvin sign, the one character
    outside ASCII whose lower case is an ASCII letter, is put aside first.
    """
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ"))
    return F.array_remove(F.split(F.lower(plain), WORD_BREAK), "")


def template_words(text: str) -> list[str]:
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower())


def with_words(docs: DataFrame, *kept: str) -> DataFrame:
    """Words as a column of its own; the generator keeps them from being computed once per use."""
    return docs.select(*kept, F.explode(F.array(words_of(F.col("text")))).alias("words"))


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Files that hold each word of a vocabulary; at most one row per word comes back."""
    known = F.array(*[F.lit(w) for w in vocabulary])
    found = docs.select(F.explode(F.array_intersect(known, words_of(F.col("text")))).alias("word"))
    return {row["word"]: row["count"] for row in found.groupBy("word").count().collect()}


def build_index(docs: DataFrame, templates: dict, settings: ScanSettings) -> tuple[list[str], list[tuple]]:
    """Indexed words from the rarest on, and postings ``(word, template, place)``."""
    words = {name: template_words(text) for name, (text, _) in templates.items()}
    vocabulary = sorted({w for ws in words.values() for w in ws})
    files = document_frequencies(docs, vocabulary)
    rarity = lambda w: (files.get(w, 0), w)  # noqa: E731  ascending: IDF from the highest on
    postings = []
    for name, ws in words.items():
        distinct = sorted(set(ws), key=rarity)
        chosen = set(distinct[: min(settings.template_words, max(3, math.ceil(len(distinct) / 2)))])
        postings += [(w, name, place) for place, w in enumerate(ws) if w in chosen]
    return sorted({w for w, _, _ in postings}, key=rarity), postings


def base_places(words: Column) -> Column:
    """``array<struct<start, label>>`` of the base phrases."""
    word = lambda i: F.get(words, i)
    label = lambda i: (
        F.when(word(i) != "license", None)
        .when(word(i - 1) == "mit", "mit")
        .when(word(i - 1) == "apache", "apache")
        .when((word(i - 1) == "public") & (word(i - 2) == "general"), "gpl")
    )
    places = F.filter(F.sequence(F.lit(1), F.size(words) - 1), lambda i: label(i).isNotNull())
    found = F.transform(
        places, lambda i: F.struct((i - F.when(label(i) == "gpl", 2).otherwise(1)).cast("bigint").alias("start"), label(i).alias("label"))
    )
    none = F.array().cast("array<struct<start:bigint,label:string>>")
    return F.when(F.array_contains(words, "license") & (F.size(words) > 1), found).otherwise(none)


def row_key() -> Column:
    """Rows with one key have one result, so they are matched once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.xxhash64(text), F.length(text))


def template_matches(docs: DataFrame, templates: dict, settings: ScanSettings) -> DataFrame:
    """``key, template, start, share``: verified alignments of templates in the distinct files of ``docs``."""
    spark = docs.sparkSession
    ranked, postings = build_index(docs, templates, settings)
    index = spark.createDataFrame(postings, "word string, template string, place int")
    sizes = {name: len({place for _, n, place in postings if n == name}) for name in templates}
    files = with_words(docs.select("text", row_key().alias("key")), "key")
    files = files.withColumn("indexed", F.array_intersect(F.array(*[F.lit(w) for w in ranked]), F.col("words"))).where(F.size("indexed") > 0)
    at = F.filter(
        F.transform("words", lambda w, i: F.when(F.array_contains("indexed", w), F.struct(i.alias("at"), w.alias("word")))),
        lambda x: x.isNotNull(),
    )
    votes = files.select("key", F.inline(at)).join(F.broadcast(index), "word")  # the index is a few hundred rows by its settings
    # dealt by file and template at once, so that sums and the neighbours of a start need no other shuffle
    votes = votes.select("key", "template", (F.col("at") - F.col("place")).alias("start"), "place").repartition("key", "template")
    near = Window.partitionBy("key", "template").orderBy("start").rangeBetween(-settings.slack, settings.slack)
    aligned = votes.groupBy("key", "template", "start").agg(F.collect_set("place").alias("places"))
    aligned = aligned.withColumn("held", F.size(F.array_distinct(F.flatten(F.collect_list("places").over(near)))))
    size = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])[F.col("template")]
    aligned = aligned.withColumn("share", F.col("held") / size).where(F.col("share") >= settings.min_share)
    candidates = aligned.groupBy("key").agg(F.collect_set(F.struct("template", "start", "share", F.size("places").alias("own"))).alias("candidates"))
    held = files.select("key", "words").join(candidates, "key").dropDuplicates(["key"])
    checked = F.filter("candidates", lambda c: phrases_stand(F.col("words"), c["template"], c["start"], templates, settings.slack))
    # of starts a few words apart, the best one
    rank = F.struct("share", "own", -F.col("start"))
    found = held.select("key", F.inline(checked)).withColumn("best", F.max(rank).over(near))
    return found.where(F.col("best") == rank).select("key", "template", "start", "share")


def phrases_stand(words: Column, template: Column, start: Column, templates: dict, slack: int) -> Column:
    """Whether every mandatory phrase of a template stands near its place of the alignment."""
    result = F.lit(False)
    for name, (text, phrases) in templates.items():
        ws = template_words(text)
        standing = F.lit(True)
        for phrase in phrases:
            p = phrase.split()
            place = next(i for i in range(len(ws)) if ws[i : i + len(p)] == p)
            standing &= stands_near(words, p, start + place, slack)
        result = F.when(template == name, standing).otherwise(result)
    return result


def stands_near(words: Column, phrase: list[str], at: Column, slack: int) -> Column:
    wanted = F.array(*[F.lit(w) for w in phrase])
    return F.exists(
        F.sequence(F.lit(-slack), F.lit(slack)),
        lambda s: (at + s >= 0) & (F.slice(words, F.greatest(at + s, F.lit(0)) + 1, len(phrase)) == wanted),
    )


def license_scan(docs: DataFrame, templates: dict = TEMPLATES, settings: ScanSettings = ScanSettings()) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``): words, base places, labels, and the best score.

    The score is the largest share of indexed words of a verified template; a base phrase alone counts 0.5.
    """
    base = with_words(docs.select("doc_id", "text", row_key().alias("key")), "doc_id", "key").select(
        "doc_id", "key", F.size("words").cast("bigint").alias("n_words"), base_places(F.col("words")).alias("places")
    )
    found = template_matches(docs, templates, settings).groupBy("key").agg(
        F.collect_set("template").alias("added"),
        F.max("share").alias("best"),
        F.sort_array(F.collect_set(F.struct("start", "template", "share"))).alias("matches"),
    )
    starts = F.transform("places", lambda p: p["start"])
    base_labels = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    labels = F.array_sort(F.array_union(base_labels, F.coalesce(F.col("added"), F.array().cast("array<string>"))))
    return base.join(found, "key", "left").select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.size("places") > 0, 0.5).otherwise(0.0)).alias("score"),
        "matches",
    )
