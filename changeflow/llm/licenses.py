"""License scan in native expressions: phrases word by word, and an exact set-similarity join with templates.

A text block (a line, or ``SPAN`` lines that follow one another, for wrapped notices) matches a
template when it holds at least ``THRESHOLD`` of the template's distinct words, and among them those
that tell the license from its neighbours. Words are ordered by how many blocks of the whole corpus have them, rarest first. A
match must share a word within the first ``|T| - a + 1`` words of the template and the first
``|B| - a + 1`` of the block, where ``a`` is the overlap needed; length and position rule out more
before sets are compared.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import LOWER, UPPER, doc_texts, written

# Phrases and their labels, which the contract names.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# What common license notices say.
TEMPLATES = [
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Released under the BSD License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "Creative Commons Attribution NonCommercial International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "Creative Commons Attribution ShareAlike International License"),
    ("cc0", "To the extent possible under law the person has waived all copyright and related rights to this work CC0"),
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-notice", "you can redistribute it and or modify it under the terms of the GNU General Public License"),
    ("isc", "Permission to use, copy, modify, and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mit-notice", "Released under the MIT License"),
    ("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "subject to the terms of the Mozilla Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
# Words that a label's templates need where they hold them, and words that rule a label out.
DECIDING = {"agpl": "affero", "apache-2.0": "apache", "bsd": "bsd", "cc-by-nc": "nc noncommercial", "cc-by-sa": "sa sharealike", "gpl-notice": "gnu general", "lgpl": "lesser", "mit-notice": "mit", "mpl": "mozilla"}
EXCLUDED = {"gpl-notice": "affero lesser library"}
THRESHOLD = 0.8
#: Lines of a block: longer than any template wrapped at 72 columns.
SPAN = 3

#: What separates words: all of ASCII but digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_words(text: str) -> list[str]:
    return sorted({w for w in "".join(c if c.isalnum() else " " for c in text.lower()).split()})


def deciding_words(label: str, text: str) -> list[str]:
    return sorted(set(DECIDING.get(label, "").split()) & set(template_words(text)))


def excluded_words(label: str) -> list[str]:
    return EXCLUDED.get(label, "").split()


def overlap_needed(n: int) -> int:
    return math.ceil(THRESHOLD * n - 1e-9)


def _spaced(text: Column) -> Column:
    """Words with a space on both sides of each, so that neighbours share none; empty without words."""
    parted = F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), SEPARATORS, " "))
    return F.when(parted == "", F.lit("")).otherwise(F.concat(F.lit(" "), F.replace(parted, F.lit(" "), F.lit("  ")), F.lit(" ")))


def _count(text: Column, piece: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(piece), F.lit("")))) / len(piece)).cast("long")


def _n_words(spaced: Column) -> Column:
    """Words of a spaced text, or of a part of one that begins and ends beside a word."""
    return F.when(spaced == "", F.lit(0).cast("long")).otherwise(_count(spaced, "  ") + 1)


def _phrases(docs: DataFrame) -> DataFrame:
    spaced, total = F.col("spaced"), F.col("n_words")
    columns = {}
    for k, phrase in enumerate(PHRASES):
        words = phrase.split()
        mark = " " + "  ".join(words) + " "
        n = _count(spaced, mark)
        columns[f"n{k}"] = n
        columns[f"first{k}"] = F.when(n > 0, _n_words(F.substring_index(spaced, mark, 1)))
        columns[f"last{k}"] = F.when(n > 0, total - _n_words(F.substring_index(spaced, mark, -1)) - len(words))
    return docs.withColumns(columns)


def _sets(lines: Column, vocabulary: list[str]) -> Column:
    """The template words of each line."""
    known = F.array(*map(F.lit, vocabulary))
    return F.transform(lines, lambda line: F.array_intersect(F.split(line, SEPARATORS), known))


def _blocks(sets: Column, least: int) -> Column:
    """Sets of single lines and of ``SPAN`` lines in a row; those with fewer words than any template needs are left out."""
    spans = sets
    for k in range(2, SPAN + 1):
        spans = F.zip_with(spans, F.slice(sets, F.lit(k), F.size(sets)), lambda a, b: F.array_union(a, F.coalesce(b, F.array().cast("array<string>"))))
    large = lambda s: F.size(s) >= least
    return F.array_distinct(F.transform(F.concat(F.filter(sets, large), F.slice(F.filter(spans, large), 1, F.size(sets))), lambda s: F.array_sort(s)))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every row.

    ``n_base`` counts the places of the phrases, ``first_word`` and ``last_word`` are their smallest
    and largest start. ``labels`` adds those of templates that a line matches. ``score`` is 1 where
    a phrase stands, else the largest share of a matching template's words, else 0.

    Null, empty and wordless texts have no words, labels or places. Repeated rows and null doc_ids
    are kept. Other columns are not read. An empty table gives no rows.
    """
    templates = [(k, label, template_words(text)) for k, (label, text) in enumerate(TEMPLATES)]
    vocabulary = sorted({w for _, _, words in templates for w in words} | {w for label in EXCLUDED for w in excluded_words(label)})
    least = min(overlap_needed(len(words)) for _, _, words in templates)
    spark = docs.sparkSession

    rows = doc_texts(docs).withColumn("row", F.monotonically_increasing_id()).withColumn("spaced", _spaced(F.col("text")))
    rows = _phrases(rows.withColumn("n_words", _n_words(F.col("spaced"))))
    k = range(len(PHRASES))
    labels = F.array_compact(F.array(*(F.when(F.col(f"n{i}") > 0, F.lit(label)) for i, label in enumerate(PHRASES.values()))))
    rows = rows.select(
        "row", "doc_id", "n_words",
        sum((F.col(f"n{i}") for i in k), F.lit(0).cast("long")).alias("n_base"),
        F.least(*(F.col(f"first{i}") for i in k)).alias("first_word"), F.greatest(*(F.col(f"last{i}") for i in k)).alias("last_word"),
        labels.alias("base"), _sets(F.split(F.translate("text", UPPER, LOWER), "\n"), vocabulary).alias("sets"),
    )
    rows = written(rows.withColumn("blocks", _blocks(F.col("sets"), least)).drop("sets"), "license-rows")

    # Equal sets of template words are one block: common ones, like those of plain prose, are joined once.
    blocks = rows.select("row", F.explode("blocks").alias("words"))
    counted = written(blocks.groupBy("words").agg(F.count("*").alias("n")), "license-blocks")
    # At most one row for each word of the templates.
    frequency = counted.select(F.explode("words").alias("word"), "n").groupBy("word").agg(F.sum("n").alias("n")).collect()
    seen = {r.word: r.n for r in frequency}
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (seen.get(w, 0), w)))}
    ranked = F.create_map(*(F.lit(x) for w, i in rank.items() for x in (w, i)))

    side = []
    for t, label, words in templates:
        order = sorted(rank[w] for w in words)
        a = overlap_needed(len(order))
        must, never = ([rank[w] for w in ws] for ws in (deciding_words(label, TEMPLATES[t][1]), excluded_words(label)))
        side += [(t, label, order, must, never, a, r, p) for p, r in enumerate(order[: len(order) - a + 1])]
    prefixes = spark.createDataFrame(side, "template int, label string, t_words array<int>, must array<int>, never array<int>, need int, rank int, t_at int")
    tokens = counted.select("words", F.array_sort(F.transform("words", lambda w: ranked[w])).alias("b_words"))
    probes = tokens.select("words", "b_words", F.posexplode("b_words").alias("b_at", "rank"))
    met = probes.join(F.broadcast(prefixes), "rank").where(
        (F.size("b_words") >= F.col("need"))
        & (F.col("b_at") <= F.size("b_words") - F.col("need"))
        & (F.least(F.size("b_words") - F.col("b_at"), F.size("t_words") - F.col("t_at")) >= F.col("need") - F.least("b_at", "t_at"))
    )
    shared = F.size(F.array_intersect("b_words", "t_words"))
    told = (F.size(F.array_except("must", "b_words")) == 0) & ~F.arrays_overlap("never", "b_words")
    hits = met.where(told).dropDuplicates(["words", "template"]).withColumn("shared", shared).where(F.col("shared") >= F.col("need"))
    hits = hits.groupBy("words").agg(F.collect_set("label").alias("more"), F.max(F.col("shared") / F.size("t_words")).alias("share"))
    found = blocks.join(hits, "words").groupBy("row").agg(F.array_distinct(F.flatten(F.collect_set("more"))).alias("more"), F.max("share").alias("share"))

    joined = rows.drop("blocks").join(found, "row", "left")
    everything = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(everything, ",").alias("labels"), F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def oracle_sql() -> str:
    """The scan in DuckDB SQL, by comparing every block with every template."""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = lambda c: f"regexp_extract_all(translate({c}, '{UPPER}', '{LOWER}'), '{pattern}')"
    quoted = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]::varchar[]"
    templates = ", ".join(f"('{label}', {quoted(template_words(text))}, {quoted(deciding_words(label, text))}, {quoted(excluded_words(label))}, {overlap_needed(len(template_words(text)))})" for label, text in TEMPLATES)
    places = ", ".join(f"[{{'at': i, 'label': '{label}'}} for i in range(len(w) - {len(p.split()) - 1}) if w[i + 1 : i + {len(p.split())}] = {quoted(p.split())}]" for p, label in PHRASES.items())
    return f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (select r, doc_id, {words("text")} as w from d),
p as (select r, doc_id, len(w) as n_words, flatten([{places}]) as places from w),
t(label, words, must, never, need) as (values {templates}),
l as (select r, ls, unnest(range(len(ls))) as i from (select r, string_split(text, chr(10)) as ls from d)),
blocks as (select distinct r, list_sort(list_distinct({words("block")})) as ws from (select r, ls[i + 1] as block from l union all select r, array_to_string(ls[i + 1 : i + {SPAN}], ' ') from l)),
hit as (select r, label, len(list_intersect(ws, words)) / len(words) as share from blocks, t where len(list_intersect(ws, words)) >= need and list_has_all(ws, must) and not list_has_any(ws, never)),
best as (select r, list(distinct label) as more, max(share) as share from hit group by r)
select doc_id, n_words, len(places) as n_base, list_min([x.at for x in places]) as first_word, list_max([x.at for x in places]) as last_word,
  array_to_string(list_sort(list_distinct([x.label for x in places])), ',') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat([x.label for x in places], coalesce(more, [])))), ',') as labels,
  case when len(places) > 0 then 1.0::double else coalesce(share, 0.0)::double end as score
from p left join best using (r)"""
