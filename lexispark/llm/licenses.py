"""Operator 7, license scans by an exact set-similarity join (DataFrame
functions only).

Blocks are the lines of a text, and its runs of words: twice as many as the
longest template has, the next run beginning after half of them, so that a
notice that is wrapped over lines or stands behind comment marks lies whole in
one of them.  Templates are known license notices; blocks and templates are
sets of words.  A block contains a template if it has at least ``threshold``
of the template's words.  The words of all templates are ordered by the number
of blocks that hold them, rarest first (one counting pass over the lines; only these words'
counts reach the driver).  A block that meets the threshold for template T
must share one of T's first |T| - need + 1 words in that order (prefix
filter), hold at least ``need`` template words (length filter), and, by the
places of the shared word in both ordered lists, still be able to reach
``need`` (positional filter).  What is left is verified by counting the common
words, so the result is exactly that of comparing all blocks with all
templates.

Beside the join, each place where the words of a base phrase stand one after
another is reported.

Defined results: null text counts as empty: no words, no places, no blocks;
blocks without words match nothing; repeated rows have one result each (rows
are told apart by their place in the scan, not by id); empty input gives an
empty result; ties between templates all count.  Only the named columns are
read, so others may have any name."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs of characters that separate words: ASCII other than digits and lower-case letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and labels of the base scan.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Notices that published licenses ask for, and their labels.
TEMPLATES = (
    ("agpl", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files to deal in the software without restriction"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, LOWER), SEPARATORS, -1), lambda x: x != "")


def _strings(values) -> Column:
    return F.array(*[F.lit(x) for x in values]) if values else F.array().cast("array<string>")


def token_order(docs: DataFrame, vocabulary: list[str], text: str) -> list[str]:
    """``vocabulary`` by the number of blocks that hold each word, rarest
    first.  The result has one row a word of the templates."""
    blocks = docs.select(F.explode(F.split(text, "\n", -1)).alias("line"))
    held = blocks.select(F.explode(F.array_intersect(_strings(vocabulary), words(F.col("line")))).alias("w"))
    n = {r["w"]: r["n"] for r in held.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


def _places(w: Column, phrase: str, label: str) -> Column:
    """Starts of a phrase's words in the word array, from 0."""
    parts = phrase.split()
    none = F.array().cast("array<struct<label:string,start:int>>")

    def here(i: Column) -> Column:
        same = F.lit(True)
        for k, part in enumerate(parts):
            same = same & (F.get(w, i + k) == part)
        return same

    starts = F.filter(F.sequence(F.lit(0), F.size(w) - len(parts)), here)
    found = F.transform(starts, lambda i: F.struct(F.lit(label).alias("label"), i.alias("start")))
    return F.when((F.size(w) >= len(parts)) & F.arrays_overlap(w, _strings([max(parts, key=len)])), found).otherwise(none)


def scan(docs: DataFrame, templates=TEMPLATES, base=BASE, threshold: float = 0.9, text: str = "text",
         doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, places, blocks, runs) of every row: ``places`` has
    label and first word of each base phrase, ``blocks`` has label, line (from
    0) and containment of each line that meets the threshold, ``runs`` label,
    first word and containment of each run that does.  ``templates``
    and ``base`` are (label, text) and (phrase, label) pairs."""
    spark = docs.sparkSession
    sets = [(label, sorted(set(t.split()))) for label, t in templates]
    order = token_order(docs, sorted({w for _, s in sets for w in s}), text)
    rank = {w: k for k, w in enumerate(order)}
    rows = []
    for label, s in sets:
        s = sorted(s, key=rank.get)
        need = math.ceil(threshold * len(s) - 1e-9)
        rows += [(w, label, i, need, s) for i, w in enumerate(s[:len(s) - need + 1])]
    prefixes = spark.createDataFrame(rows, "w string, label string, i int, need int, words array<string>")
    starts = sorted({r[0] for r in rows})

    low = F.translate(F.col("t"), UPPER, LOWER)
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
                      F.coalesce(F.col(text), F.lit("")).alias("t")).select("row", "doc_id", low.alias("t"))
    w = F.col("w")
    held = lambda some: F.array_intersect(_strings(order), some)
    has_start = lambda x: F.arrays_overlap(x["words"], _strings(starts))
    any_start = " or ".join(f"contains(line, '{s}')" for s in starts)
    lines = F.expr(f"filter(transform(split(t, '\\n', -1), (line, k) -> struct(k, line)), x -> {any_start.replace('(line', '(x.line')})")
    number, none = F.lit(None).cast("int"), F.array().cast("array<struct<line:int,start:int,words:array<string>>>")
    blocks = F.filter(F.transform(lines, lambda x: F.struct(
        x["k"].alias("line"), number.alias("start"), held(words(x["line"])).alias("words"))), has_start)
    step = run_step(templates)
    runs = F.filter(F.transform(F.sequence(F.lit(0), F.size(w) - 1, F.lit(step)), lambda i: F.struct(
        number.alias("line"), i.alias("start"), held(F.slice(w, i + 1, 2 * step)).alias("words"))), has_start)
    runs = F.when((F.size(w) > 0) & F.expr(any_start.replace("(line", "(t")), runs).otherwise(none)
    each = (src.select("row", "doc_id", "t", words(F.col("t")).alias("w"), blocks.alias("blocks"))
            .select("row", "doc_id", F.size(w).cast("long").alias("n_words"),
                    F.concat(*[_places(w, p, label) for p, label in base]).alias("places"), F.concat("blocks", runs).alias("blocks")))
    one = (each.select("row", "doc_id", "n_words", "places", F.explode_outer("blocks").alias("b"))
           .select("row", "doc_id", "n_words", "places", "b.line", "b.start", F.col("b.words").alias("held"))
           .select("*", F.posexplode_outer("held").alias("j", "w")))
    left = lambda n, at: n - at - 1  # noqa: E731  words after this one
    reach = F.least("i", "j") + 1 + F.least(left(F.size("words"), F.col("i")), left(F.size("held"), F.col("j")))
    hits = F.size(F.array_intersect("words", "held"))
    share = F.when((F.size("held") >= F.col("need")) & (reach >= F.col("need")) & (hits >= F.col("need")),
                   hits / F.size("words"))
    return (one.join(F.broadcast(prefixes), "w", "left")  # one row a prefix word of the given templates
            .withColumn("share", share)
            .groupBy("row", "doc_id", "n_words", "places")
            .agg(F.collect_set(F.when(F.col("share").isNotNull(), F.struct(
                "label", "line", "start", F.col("share").alias("containment")))).alias("found"))
            .select("doc_id", "n_words", "places", _found("line").alias("blocks"), _found("start").alias("runs")))


def _found(kind: str) -> Column:
    own = F.filter("found", lambda x: x[kind].isNotNull())
    return F.array_sort(F.transform(own, lambda x: F.struct(x["label"].alias("label"), x[kind].alias(kind), x["containment"].alias("containment"))))


def run_step(templates) -> int:
    """Words after which the next run begins: as many as the longest template has."""
    return max(len(t.split()) for _, t in templates)


def digest(found: DataFrame) -> DataFrame:
    """The scan's counts and comma-joined labels."""
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    base = F.transform("places", lambda p: p["label"])
    starts = F.transform("places", lambda p: p["start"].cast("long"))
    found_in = [F.transform(c, lambda b: F.struct(b["label"].alias("label"), b["containment"].alias("containment")))
                for c in ("blocks", "runs")]
    score = F.when(F.size("places") > 0, F.lit(1.0)).otherwise(
        F.coalesce(F.array_max(F.transform(F.concat(*found_in), lambda b: b["containment"])), F.lit(0.0)))
    return found.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
                        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        joined(base).alias("base_labels"),
                        joined(F.concat(base, F.transform(F.concat(*found_in), lambda b: b["label"]))).alias("labels"),
                        score.alias("score"))


def oracle(threshold: float = 0.9) -> str:
    """DuckDB SQL that compares every line and run with every template."""
    step = run_step(TEMPLATES)
    t = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(TEMPLATES))
    get = "regexp_extract_all(translate({}, '" + UPPER + "', '" + LOWER + "'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    places = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(0, len(w)), lambda i: "
        + " AND ".join(f"w[i + {k + 1}] = '{part}'" for k, part in enumerate(phrase.split()))
        + ")) AS start FROM d" for phrase, label in BASE)
    return f"""
WITH d AS (SELECT doc_id, text, {get.format("coalesce(text, '')")} AS w FROM documents),
p AS ({places}),
pb AS (SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word FROM p GROUP BY doc_id),
tpl AS (SELECT label, list_distinct(string_split(txt, ' ')) AS tw FROM (VALUES {t}) v(i, label, txt)),
ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
lw AS (SELECT doc_id, list_distinct({get.format("line")}) AS lw FROM ln
       UNION ALL
       SELECT doc_id, list_distinct(w[i + 1:i + {2 * step}]) AS lw FROM (SELECT doc_id, w, unnest(range(0, len(w), {step})) AS i FROM d)),
c AS (SELECT doc_id, label, len(list_intersect(tw, lw)) AS hits, len(tw) AS n FROM lw, tpl),
m AS (SELECT doc_id, label, hits / n AS share FROM c WHERE hits >= ceil({threshold} * n - 1e-9)),
lab AS (SELECT doc_id, label FROM p UNION SELECT doc_id, label FROM m),
bl AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS base_labels FROM (SELECT DISTINCT doc_id, label FROM p) GROUP BY doc_id),
al AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM lab GROUP BY doc_id),
ms AS (SELECT doc_id, max(share) AS share FROM m GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(pb.n_base, 0) AS n_base, pb.first_word, pb.last_word,
       coalesce(bl.base_labels, '') AS base_labels, coalesce(al.labels, '') AS labels,
       CASE WHEN pb.n_base > 0 THEN 1.0 ELSE coalesce(ms.share, 0.0) END AS score
FROM d LEFT JOIN pb USING (doc_id) LEFT JOIN bl USING (doc_id) LEFT JOIN al USING (doc_id) LEFT JOIN ms USING (doc_id)
"""
