"""License scan: an exact set-similarity join of text blocks with license templates.

A block is a window of words, half overlapping the next. Templates are in length classes, each with blocks of its own, at
least twice as long as its templates, so that each run of words as long as a template lies in one: sentences and whole
licence texts are found alike. A block matches a template if it holds at least the share `threshold` of the template's
distinct words, and one of its telling phrases, if it has any: licences of a family differ by one word. Words are ordered by
how often they occur in all texts, rare ones first. Then only pairs that share a word of both prefixes can match (prefix
filter), only blocks with enough words (length filter), and only if enough words are left after the first common one
(positional filter). What passes is counted exactly. Everything is a DataFrame expression.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Sentences of well-known public license notices, and the label of each.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("mit", "Released under the MIT License"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
)

#: Phrases that tell the notices of one family apart, by label. A template that holds one of its label's phrases
#: matches only blocks that hold one too.
TELLING = {
    "mit": ("mit license",),
    "apache": ("apache license",),
    "gpl": ("gnu general",),
    "lgpl": ("gnu lesser", "lesser general"),
    "agpl": ("gnu affero", "affero general"),
    "cc-by": tuple(f"attribution {after}" for after in ("1", "2", "3", "4", "international", "license")),
    "cc-by-sa": ("sharealike", "share alike"),
}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
THRESHOLD = 0.8
#: Words from one block to the next, of the shortest templates; a block is twice as long. A longer template has the least
#: double of it, and of that, that is no shorter than the template.
STRIDE = 32


def template_words(text: str) -> list[str]:
    """The distinct words of a template, in order."""
    return list(dict.fromkeys(_plain(text)))


def _plain(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def stride_of(text: str) -> int:
    """The stride of a template's length class."""
    stride = STRIDE
    while stride < len(_plain(text)):
        stride *= 2
    return stride


def telling(label: str, text: str) -> list[str]:
    """The phrases of which a block must hold one to match the template; none if the template holds none itself."""
    line = f" {' '.join(_plain(text))} "
    phrases = [f" {phrase} " for phrase in TELLING.get(label, ())]
    return phrases if any(phrase in line for phrase in phrases) else []


def needed(words: list[str], threshold: float = THRESHOLD) -> int:
    """The least number of a template's words that meets the threshold."""
    return next(n for n in range(1, len(words) + 1) if n / len(words) >= threshold)


def _words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def vocabulary_order(docs: DataFrame, text: str, vocabulary: list[str]) -> list[str]:
    """The vocabulary of the templates by the number of its occurrences in all texts, rare words first.

    The counts are summed where the texts are; one number per word of the templates, a fixed list, reaches the driver.
    """
    hits = docs.select(F.explode(F.filter(_words(F.col(text)), lambda w: w.isin(vocabulary))).alias("word"))
    counts = {row["word"]: row["count"] for row in hits.groupBy("word").count().collect()}
    return sorted(vocabulary, key=lambda word: (counts.get(word, 0), word))


def _phrase_starts(words: Column, phrase: str) -> Column:
    first, *rest = phrase.split(" ")

    def at(word: Column, i: Column) -> Column:
        here = word == first
        for k, other in enumerate(rest, 1):
            here = here & (F.get(words, i + k) == other)
        return F.when(here, i)

    return F.array_compact(F.transform(words, at))


def scan_licenses(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of `docs`: the id, `n_words`, `n_base` (places of phrases), `first_word` and `last_word` (their
    smallest and largest start, NULL without one), `base_labels` and `labels` (arrays, sorted), and `score`: 1 if a phrase
    was found, else the greatest share of a template's words that any block holds, if that is the threshold or more, else 0.

    A template, of any length, is found wherever it begins if its words spread over no more than the stride of its class
    (`stride_of`, 32 or more) and one. A NULL or empty text has no words and the score 0. Repeated rows are each reported.
    Other columns are not carried.
    """
    templates = tuple(t for t in templates if template_words(t[1]))
    order = vocabulary_order(docs, text, sorted({word for _, sentence in templates for word in template_words(sentence)}))
    rank = {word: i for i, word in enumerate(order)}
    sets = [
        (label, stride_of(sentence), sorted(template_words(sentence), key=rank.get), telling(label, sentence))
        for label, sentence in templates
    ]
    heads: dict[int, set[str]] = {}
    for _, stride, words, _ in sets:
        heads.setdefault(stride, set()).update(words[: len(words) - needed(words, threshold) + 1])
    phrases = sorted({phrase for *_, tell in sets for phrase in tell})
    # As long as the fixed list of templates, whatever the texts.
    index = F.broadcast(
        docs.sparkSession.createDataFrame(
            [
                (stride, rank[word], label, [rank[w] for w in words], i, needed(words, threshold), tell)
                for label, stride, words, tell in sets
                for i, word in enumerate(words[: len(words) - needed(words, threshold) + 1])
            ],
            "stride int, head int, label string, template array<int>, place int, need int, tell array<string>",
        )
    )

    words = F.col("words")
    starts = {phrase: _phrase_starts(words, phrase) for phrase in PHRASES}
    candidate = F.exists(words, lambda w: w.isin(sorted({p.split(" ")[0] for p in PHRASES})))
    none = F.array().cast("array<int>")
    places = F.when(candidate, F.array(*starts.values())).otherwise(F.array(*(none for _ in starts)))
    ranks = F.create_map(*(F.lit(x) for item in rank.items() for x in item))
    told = F.array(*map(F.lit, phrases)).cast("array<string>")

    def blocks_of(stride: int) -> Column:
        """Windows that hold a word of a prefix, few, since those words are the rarest: the ranks and phrases in each."""
        hit = F.transform(words, lambda w, i: F.when(w.isin(sorted(heads[stride])), F.floor(i / stride)))
        numbers = F.transform(F.array_compact(hit), lambda block: F.array(F.greatest(block - 1, F.lit(0)), block))
        numbers = F.array_distinct(F.flatten(numbers))
        windows = F.transform(numbers, lambda block: F.slice(words, (block * stride + 1).cast("int"), 2 * stride))

        def parts(window: Column) -> Column:
            inside = F.filter(window, lambda w: w.isin(order))
            return F.struct(
                F.lit(stride).alias("stride"),
                F.sort_array(F.array_distinct(F.transform(inside, lambda w: ranks[w]))).alias("ranks"),
                F.concat(F.lit(" "), F.array_join(window, " "), F.lit(" ")).alias("line"),
            )

        return F.transform(
            F.transform(windows, parts),
            lambda b: F.struct(
                b["stride"].alias("stride"),
                b["ranks"].alias("ranks"),
                F.filter(told, lambda phrase: F.contains(b["line"], phrase)).alias("told"),
            ),
        )

    blocks = F.concat(*map(blocks_of, sorted(heads))) if heads else F.array().cast(
        "array<struct<stride:int,ranks:array<int>,told:array<string>>>"
    )

    found = (
        docs.select(F.col(id).alias("id"), _words(F.col(text)).alias("words"))
        .select("id", "words", places.alias("places"))
        .select(
            "id",
            F.size("words").cast("long").alias("n_words"),
            F.flatten("places").alias("starts"),
            F.filter(
                F.array(*(F.when(F.size(F.col("places")[i]) > 0, label) for i, label in enumerate(PHRASES.values()))),
                lambda label: label.isNotNull(),
            ).alias("base_labels"),
            blocks.alias("blocks"),
        )
        .select(
            F.monotonically_increasing_id().alias("row"),
            "id",
            "n_words",
            F.size("starts").cast("long").alias("n_base"),
            F.array_min("starts").cast("long").alias("first_word"),
            F.array_max("starts").cast("long").alias("last_word"),
            F.array_sort(F.array_distinct("base_labels")).alias("base_labels"),
            "blocks",
        )
        .withColumn("piece", F.explode_outer("blocks"))
        .withColumns({"block": F.col("piece.ranks"), "stride": F.col("piece.stride"), "told": F.col("piece.told")})
        .drop("blocks", "piece")
    )
    heads_of = found.withColumn("head", F.explode_outer("block")).withColumn(
        "spot", F.array_position("block", F.col("head")) - 1
    )
    joined = heads_of.join(index, ["stride", "head"], "left")
    left_here, left_there = F.size("block") - F.col("spot"), F.size("template") - F.col("place")
    passes = (
        ((F.size("tell") == 0) | F.arrays_overlap("told", "tell"))
        & (F.size("block") >= F.col("need"))
        & (F.col("spot") <= F.size("block") - F.col("need"))
        & (F.least(left_here, left_there) >= F.col("need"))
    )
    shared = F.when(passes, F.size(F.array_intersect("block", "template")))
    share = F.when(shared >= F.col("need"), shared / F.size("template"))
    return (
        joined.select("row", "id", "n_words", "n_base", "first_word", "last_word", "base_labels", "label", share.alias("share"))
        .groupBy("row")
        .agg(
            *(F.first(c).alias(c) for c in ("id", "n_words", "n_base", "first_word", "last_word", "base_labels")),
            F.collect_set(F.when(F.col("share").isNotNull(), F.col("label"))).alias("more"),
            F.max("share").alias("share"),
        )
        .select(
            F.col("id").alias(id),
            "n_words",
            "n_base",
            "first_word",
            "last_word",
            "base_labels",
            F.array_sort(F.array_union("base_labels", "more")).alias("labels"),
            F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
        )
    )


def digest(scanned: DataFrame) -> DataFrame:
    """The same with labels comma-joined."""
    return scanned.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


def sql(templates: tuple[tuple[str, str], ...] = TEMPLATES) -> str:
    """Every block of a template's length class against the template, counted."""
    values = ", ".join(
        f"('{label}', {stride_of(t)}, {template_words(t)!r}, {needed(template_words(t))}, {telling(label, t)!r}::varchar[])"
        for label, t in templates
    )
    phrases = ", ".join(f"({phrase.split(' ')!r}, '{label}')" for phrase, label in PHRASES.items())
    return f"""
with docs as (
  select row_number() over () as row_id, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') as words
  from documents),
templates(label, stride, words, need, tell) as (values {values}),
phrases(words, label) as (values {phrases}),
places as (
  select row_id, p.label, i from (select *, unnest(range(len(words))) as i from docs) d, phrases p
  where d.words[i + 1:i + len(p.words)] = p.words),
base as (
  select row_id, count(*) as n_base, min(i) as first_word, max(i) as last_word,
    list_sort(list(distinct label)) as base_labels from places group by all),
blocks as (
  select row_id, stride, words[k * stride + 1:(k + 2) * stride] as words
  from (select *, unnest(range((len(words) + stride - 1) // stride)) as k
        from docs, (select distinct stride from templates))),
lines as (select *, ' ' || array_to_string(words, ' ') || ' ' as line from blocks),
matches as (
  select row_id, label, len(list_intersect(t.words, b.words)) / len(t.words)::double as share
  from lines b join templates t using (stride)
  where len(list_intersect(t.words, b.words)) >= need
    and (len(tell) = 0 or len(list_filter(tell, lambda p: contains(line, p))) > 0)),
more as (select row_id, max(share) as share, list(distinct label) as labels from matches group by all)
select d.doc_id, len(d.words)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word,
  last_word::bigint as last_word, coalesce(array_to_string(base_labels, ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(base_labels, labels))), ','), '') as labels,
  case when n_base > 0 then 1.0::double else coalesce(share, 0) end as score
from docs d left join base using (row_id) left join more using (row_id)
"""


SQL = sql()
