"""License notices in text, by exact phrases and by a set-similarity join.

A document is cut into blocks: its lines, and long lines as well as the whole text,
line ends or not, into overlapping runs of words, so that a notice wrapped over lines
lies in one block. A block matches a template if it holds at least ``threshold`` of the
template's distinct tokens. The join is exact and reads few blocks closely:

- tokens are ordered by how many documents of the whole corpus hold them, rarest first;
- prefix filter: a match shares one of the first ``size - need + 1`` tokens of the
  template, so only blocks with such a token are cut out and joined;
- length filter: a block needs ``need`` tokens that any template has;
- positional filter: from the places of the shared token in both orders follows the
  most that can still be shared.

Templates are parameters, so what is gathered (their token counts) and broadcast
(their prefixes) is as small as they are. Everything is DataFrame operations.

Defined results: a null or empty text has no words and no label; rows equal in id
and text get equal results; without templates only phrases count.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import ID, KEYS, MARK, row_id, text_mark

#: Fixed values of the contract: phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Public notices, in the words their licenses ask for.
TEMPLATES = [
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
]
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KELVIN = "\u212A"


def words(text: Column) -> Column:
    """Words with A-Z lower-cased.

    ``lower`` also folds letters beyond ASCII, which no phrase or token has and which
    leaves every word where it is; the Kelvin sign would become a k and is put away.
    """
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(KELVIN), F.lit("Å")))
    return F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))


def tokens(text: str) -> list[str]:
    """Distinct ASCII words of a template."""
    kept = "".join(c if c.isalnum() else " " for c in text.lower())
    return list(dict.fromkeys(kept.split()))


def _places(phrase: str) -> Column:
    """Starts of a phrase in the words ``w``."""
    parts = phrase.split()

    def start(word: Column, i: Column) -> Column:
        same = word == parts[0]
        for k, part in enumerate(parts[1:], 1):
            same &= F.get(F.col("w"), i + k) == part
        return F.when(same, i)

    starts = F.filter(F.transform("w", start), lambda i: i.isNotNull())
    return F.when(F.array_contains("w", parts[0]) & F.array_contains("w", parts[-1]), starts).otherwise(F.array().cast("array<int>"))


def phrase_counts(docs: DataFrame, phrases: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row keys, words, places of all phrases and their labels, for every row."""
    rows = docs.select(row_id(id_col).alias(ID), text_mark(text_col).alias(MARK), words(F.col(text_col)).alias("w"))
    place = [_places(p) for p in phrases]
    rows = rows.select(*KEYS, F.size("w").cast("long").alias("n_words"), *[p.alias(f"p{i}") for i, p in enumerate(place)])
    all_places = F.concat(*[F.col(f"p{i}") for i in range(len(place))])
    labels = F.array_compact(F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, label in enumerate(phrases.values())]))
    rows = rows.select(*KEYS, "n_words", all_places.alias("places"), F.array_sort(F.array_distinct(labels)).alias("base"))
    return rows.select(
        *KEYS, "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"), "base",
    )


def token_order(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> list[str]:
    """The tokens by the number of documents that hold them, rarest first."""
    held = docs.select(F.explode(F.array_intersect(words(F.col(text_col)), F.lit(vocabulary))).alias("token"))
    counts = {r.token: r["count"] for r in held.groupBy("token").count().collect()}
    return sorted(vocabulary, key=lambda t: (counts.get(t, 0), t))


def blocks(docs: DataFrame, size: int, text_col: str = "text") -> DataFrame:
    """The words of every line and of the whole text in ``block``; if longer, in runs of ``size`` that overlap by half."""
    text = F.col(text_col)
    parts = F.when(F.contains(text, F.lit("\n")), F.concat(F.split(text, "\n"), F.array(text))).otherwise(F.array(text))
    lines = docs.select(*KEYS, F.explode(parts).alias("line")).select(*KEYS, words(F.col("line")).alias("w"))
    step = size // 2
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - step - 1, F.lit(0)), F.lit(step))
    return lines.select(*KEYS, F.explode(F.transform(starts, lambda at: F.slice("w", at + 1, size))).alias("block"))


def matches(
    docs: DataFrame,
    templates: list[tuple[str, str]],
    threshold: float = 0.9,
    block_words: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``document, template, label, contained``: the best block of each matching template."""
    spark = docs.sparkSession
    per = round(100 * threshold)
    sets = [(label, tokens(text)) for label, text in templates]
    order = token_order(docs, sorted({t for _, ts in sets for t in ts}), text_col)
    rank = {t: i for i, t in enumerate(order)}
    schema = "token string, template int, label string, i int, size int, need int, tokens array<string>"
    postings = []
    for n, (label, ts) in enumerate(sets):
        own = sorted(ts, key=rank.__getitem__)
        need = ceil(per * len(own) / 100)
        postings += [(t, n, label, i, len(own), need, own) for i, t in enumerate(own[: len(own) - need + 1])]
    first = sorted({p[0] for p in postings})
    rows = docs.select(row_id(id_col).alias(ID), text_mark(text_col).alias(MARK), F.col(text_col).alias("text"))
    rows = rows.filter(F.arrays_overlap(words(F.col("text")), F.lit(first)))
    least = min((p[5] for p in postings), default=1)
    found = blocks(rows, block_words).filter(F.arrays_overlap("block", F.lit(first)))
    found = found.select(*KEYS, F.array_intersect(F.lit(order), F.col("block")).alias("own")).filter(F.size("own") >= least)
    met = found.select(*KEYS, "own", F.posexplode("own").alias("j", "token")).join(F.broadcast(spark.createDataFrame(postings, schema)), "token")
    met = met.filter(F.size("own") >= F.col("need"))
    met = met.filter(1 + F.least(F.col("size") - F.col("i") - 1, F.size("own") - F.col("j") - 1) >= F.col("need"))
    shared = met.withColumn("shared", F.size(F.array_intersect("tokens", "own"))).filter("shared >= need")
    return shared.groupBy(*KEYS, "template", "label").agg(F.max(F.col("shared") / F.col("size")).alias("contained"))


def scan(
    docs: DataFrame,
    phrases: dict[str, str] | None = None,
    templates: list[tuple[str, str]] | None = None,
    threshold: float = 0.9,
    block_words: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Row keys, ``n_words, n_base, first_word, last_word``, sorted labels of phrases
    (``base``) and of both (``labels``), and ``score``: 1 for a phrase, else the
    largest part of a template that one block holds, 0 below the threshold."""
    base = phrase_counts(docs, PHRASES if phrases is None else phrases, id_col, text_col)
    found = matches(docs, TEMPLATES if templates is None else templates, threshold, block_words, id_col, text_col)
    per_doc = found.groupBy(*KEYS).agg(F.collect_set("label").alias("more"), F.max("contained").alias("contained"))
    none = F.array().cast("array<string>")
    return base.join(per_doc, KEYS, "left").select(
        *KEYS, "n_words", "n_base", "first_word", "last_word", "base",
        F.array_sort(F.array_union("base", F.coalesce("more", none))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("contained", F.lit(0.0))).alias("score"),
    )


def scan_sql() -> str:
    """The same over ``documents`` in DuckDB, comparing every block of a line with every template.

    It has no runs over line ends, which add nothing in the given tables.
    """
    low = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    find = f"regexp_extract_all({low}, '{WORD}')"
    sets = [(label, tokens(text)) for label, text in TEMPLATES]
    rows = ", ".join(f"('{label}', {ts!r}, {len(ts)}, {ceil(90 * len(ts) / 100)})" for label, ts in sets)
    phrases = ", ".join(f"({p.split()!r}, '{label}')" for p, label in PHRASES.items())
    return f"""
WITH d AS (SELECT doc_id, {find.format('text')} AS w FROM documents),
phrase(p, label) AS (VALUES {phrases}),
place AS (
  SELECT doc_id, label, i - 1 AS i
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) s, phrase
  WHERE w[i] = p[1] AND w[i:i + len(p) - 1] = p),
base AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_sort(list(DISTINCT label)) AS b
  FROM place GROUP BY doc_id),
template(label, t, n, need) AS (VALUES {rows}),
line AS (SELECT doc_id, {find.format('l')} AS w FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents)),
block AS (
  SELECT doc_id, w[s + 1:s + 64] AS w
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 33, 0) + 1, 32)) AS s FROM line)),
met AS (
  SELECT doc_id, label, len(list_intersect(t, w)) / n AS c, len(list_intersect(t, w)) >= need AS ok FROM block, template),
more AS (SELECT doc_id, list(DISTINCT label) AS m, max(c) AS c FROM met WHERE ok GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, array_to_string(coalesce(b, []), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b, []), coalesce(m, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)
"""
