"""License scans: an exact set-similarity join between text blocks (lines, runs of words) and license templates.

The tokens of the templates are ordered by how many documents hold them, rarest first. A block that contains at
least ``need = ceil(threshold * size)`` of a template's distinct tokens must hold one of its ``size - need + 1``
rarest (prefix filter), must have at least ``need`` template tokens (length filter), and at the first token both
share, what is left on either side must still reach ``need`` (positional filter). What passes is verified exactly.

A sentence may be wrapped over lines, so every run of ``ceil(words / threshold)`` consecutive words of a document is a
block of its template as well. Such a run holds one of the same rarest tokens: only runs around one are looked at.

DataFrame functions only. No text is shuffled: a block travels as the ranks of its template tokens, and only blocks
that pass the length filter leave the scan. The template index is bounded by the ``templates`` parameter.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, functions as F

from strikelake.sources.storage import as_table

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# The phrases looked for word by word, and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Opening or identifying sentences of public licenses. No token has the letter k, the one ASCII letter
# that lower() also makes from a character outside ASCII.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("gpl-2", "licensed under the GNU General Public License, version 2"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "To the extent possible under law the author has waived all copyright and related rights"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "All rights reserved"),
]
THRESHOLD = 0.9


def tokens_of(template: str) -> list[str]:
    """Distinct tokens of a template, in order."""
    return list(dict.fromkeys(re.findall(r"[0-9a-z]+", template.lower())))


def _words(lowered: Column) -> Column:
    return F.split(lowered, NOT_WORD + "+")


def _literal(tokens) -> Column:
    return F.array(*[F.lit(t) for t in tokens])


def rarity(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Rank of each vocabulary token by the number of documents that hold it (rarest 0, ties by code point).

    Counts all rows; what reaches the driver is one number per token of the parameter.
    """
    held = F.explode(F.array_intersect(_words(F.lower("text")), _literal(vocabulary)))
    counts = {r["token"]: r["n"] for r in docs.select(held.alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    return {t: i for i, t in enumerate(sorted(vocabulary, key=lambda t: (counts.get(t, 0), t)))}


def template_blocks(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, block, label, containment) of the blocks that hold ``threshold`` of a template's tokens.

    block is the number of the line, from 0, or null for a run of words, which may go over lines.
    """
    if not templates:
        return docs.select("doc_id").limit(0).select(
            "doc_id", F.lit(0).alias("block"), F.lit("").alias("label"), F.lit(0.0).alias("containment"))
    sets = [(label, tokens_of(text)) for label, text in templates]
    rank = rarity(docs, sorted({t for _, ts in sets for t in ts}))
    index, asked = [], []
    for (label, ts), (_, text) in zip(sets, templates):
        ordered = sorted(rank[t] for t in ts)
        need = math.ceil(threshold * len(ordered) - 1e-9)
        prefix = ordered[: len(ordered) - need + 1]
        index += [(r, label, ordered, i, len(ordered), need) for i, r in enumerate(prefix)]
        asked.append((label, ts, [t for t in ts if rank[t] in prefix], need, run_length(text, threshold)))
    least = min(i[5] for i in index)
    spark = docs.sparkSession
    prefixes = spark.createDataFrame(
        index, "rank int, label string, ordered array<int>, i int, template_size int, need int")
    ranks = F.create_map(*[F.lit(x) for t, r in rank.items() for x in (t, r)])
    line = docs.select("doc_id", F.posexplode(F.split(F.lower("text"), "\n")).alias("block", "line"))
    held = line.select("doc_id", "block", F.array_intersect(_words(F.col("line")), _literal(rank)).alias("held"))
    block = held.filter(F.size("held") >= least).select(
        "doc_id", "block", F.array_sort(F.transform("held", lambda t: F.element_at(ranks, t))).alias("have"))
    # one row per rare token of a template: as large as the templates, whatever the documents
    pairs = block.select("*", F.posexplode("have").alias("j", "rank")).join(F.broadcast(prefixes), "rank")
    left = F.lit(1) + F.least(F.col("template_size") - F.col("i") - 1, F.size("have") - F.col("j") - 1)
    shared = F.array_intersect("have", "ordered")
    lines = (
        pairs.filter((F.size("have") >= F.col("need")) & (left >= F.col("need")))
        .filter((F.array_min(shared) == F.col("rank")) & (F.size(shared) >= F.col("need")))
        .select("doc_id", "block", "label", (F.size(shared) / F.col("template_size")).alias("containment"))
    )
    return lines.unionByName(_runs(docs, list(rank), asked))


def run_length(template: str, threshold: float) -> int:
    """Words of a run in which at least ``threshold`` are the template's."""
    return math.ceil(len(re.findall(r"[0-9a-z]+", template.lower())) / threshold - 1e-9)


def _runs(docs: DataFrame, vocabulary: list[str], asked: list[tuple]) -> DataFrame:
    """template_blocks of runs of words: the best one around each of a template's rarest tokens.

    ``asked`` has a template's label, tokens, rarest tokens, least number of tokens and run length.
    """
    listed = F.array(*[
        F.struct(F.lit(label).alias("label"), _literal(tokens).alias("tokens"), _literal(prefix).alias("prefix"),
                 F.lit(need).alias("need"), F.lit(length).alias("length"))
        for label, tokens, prefix, need, length in asked])
    words = _words(F.lower("text"))
    each = docs.select("doc_id", words.alias("words"), F.array_intersect(words, _literal(vocabulary)).alias("held"))
    # what an explode hands on is worked out once, not once for every word
    open_ = each.select("doc_id", "words", F.explode(F.filter(
        listed, lambda t: F.size(F.array_intersect("held", t["tokens"])) >= t["need"])).alias("t"))
    t, n = F.col("t"), F.col("t.length")
    places = F.filter(F.sequence(F.lit(1), F.size("words")), lambda i: F.array_contains(t["prefix"], F.get("words", i - 1)))
    around = F.transform(places, lambda i: F.slice("words", F.greatest(i - n + 1, F.lit(1)), F.least(i, n) + n - 1))
    near = open_.select("doc_id", "t", F.explode(F.array_distinct(around)).alias("near"))
    near = near.filter(F.size(F.array_intersect("near", "t.tokens")) >= F.col("t.need"))
    best = F.array_max(F.transform(
        F.sequence(F.lit(1), n), lambda i: F.size(F.array_intersect(F.slice("near", i, n), t["tokens"]))))
    return near.select("doc_id", "t", best.alias("best")).filter(F.col("best") >= F.col("t.need")).select(
        "doc_id", F.lit(None).cast("int").alias("block"), "t.label", (F.col("best") / F.size("t.tokens")).alias("containment"))


def _phrase(words: str) -> str:
    return f"(?<!{WORD})" + (NOT_WORD + "+").join(words.split()) + f"(?!{WORD})"


def _places(words: Column, parts: list[str]) -> Column:
    """Numbers of the words, from 1, at which the given words stand one after another."""
    def within(w: Column) -> Column:  # bound once: an expression inside the inner function would run for every place
        every = F.sequence(F.lit(1), F.greatest(F.size(w), F.lit(1)))
        return F.filter(every, lambda i: F.slice(w, i, len(parts)) == _literal(parts))

    return F.flatten(F.transform(F.array(words), within))


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, phrases=PHRASES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Phrases are found where their words stand one after another. labels adds those of the templates that a line or a
    run of words, over lines or not, holds;
    score is the highest containment found, 1 for a phrase, 0 if nothing is found. A null text is empty: no words, no
    labels (empty strings), null positions. Rows that repeat a doc_id are kept; template labels belong to the doc_id,
    so rows of one doc_id with different texts share them. Other columns are ignored.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = as_table(template_blocks(docs, templates, threshold).groupBy("doc_id").agg(
        F.collect_set("label").alias("_more"), F.max("containment").alias("_best")), "license-blocks")
    low = F.lower("text")
    words = F.regexp_extract_all(low, F.lit(f"({WORD}+)"), F.lit(1))
    starts = {}
    for phrase in phrases:
        parts = phrase.split()
        ask = low.rlike(_phrase(phrase))
        for part in sorted(set(parts), key=len):
            ask = low.contains(part) & ask  # bytes are compared before the pattern runs
        starts[phrase] = F.when(ask, _places(words, parts)).otherwise(F.array().cast("array<int>"))
    base = docs.select(
        "doc_id", F.coalesce(F.regexp_count("text", F.lit(ANY_CASE_WORD)), F.lit(0)).cast("long").alias("n_words"),
        *[s.alias(f"_p{i}") for i, s in enumerate(starts.values())])
    places = F.array_sort(F.concat(*[F.col(f"_p{i}") for i in range(len(phrases))]))
    labels = F.array_compact(F.array(*[
        F.when(F.size(f"_p{i}") > 0, F.lit(label)) for i, label in enumerate(phrases.values())]))
    base = base.select("doc_id", "n_words", places.alias("_places"), labels.alias("_base"))
    found = found.withColumnRenamed("doc_id", "_id")
    joined = base.join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    none = F.array().cast("array<string>")
    text_of = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return joined.select(
        "doc_id", "n_words", F.size("_places").cast("long").alias("n_base"),
        (F.array_min("_places") - 1).cast("long").alias("first_word"),
        (F.array_max("_places") - 1).cast("long").alias("last_word"), text_of(F.col("_base")).alias("base_labels"),
        text_of(F.concat("_base", F.coalesce("_more", none))).alias("labels"),
        F.when(F.size("_base") > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"))


def _sql() -> str:
    duck_word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    listed = ", ".join(f"({i}, '{label}', {tokens_of(text)!r}::VARCHAR[])" for i, (label, text) in enumerate(TEMPLATES))
    places = "\nUNION ALL ".join(
        f"SELECT rid, i - 1 AS pos, '{label}' AS label FROM spans, unnest(range(1, len(words) + 1)) AS u(i) WHERE "
        + " AND ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(phrase.split()))
        for phrase, label in PHRASES.items())
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, lower(coalesce(text, '')) AS low FROM documents),
spans AS (SELECT rid, doc_id, regexp_extract_all(low, '{duck_word}') AS words FROM docs),
places AS ({places}),
base AS (SELECT rid, count(*) AS n, min(pos) AS a, max(pos) AS z, list(DISTINCT label) AS labels FROM places GROUP BY rid),
templates(t, label, tokens) AS (VALUES {listed}),
lines AS (SELECT doc_id, list_distinct(regexp_extract_all(line, '{duck_word}')) AS words
          FROM (SELECT doc_id, unnest(string_split(low, chr(10))) AS line FROM docs)),
hits AS (SELECT doc_id, label, len(list_intersect(words, tokens)) / len(tokens) AS c FROM lines, templates
         WHERE len(list_intersect(words, tokens)) >= ceil({THRESHOLD} * len(tokens) - 1e-9)),
more AS (SELECT doc_id, list(DISTINCT label) AS labels, max(c) AS c FROM hits GROUP BY doc_id)
SELECT spans.doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word,
       z::BIGINT AS last_word, coalesce(list_aggregate(list_sort(base.labels), 'string_agg', ','), '') AS base_labels,
       coalesce(list_aggregate(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))),
                'string_agg', ','), '') AS labels,
       CASE WHEN n > 0 THEN 1.0 ELSE coalesce(c, 0) END::DOUBLE AS score
FROM spans LEFT JOIN base USING (rid) LEFT JOIN more ON more.doc_id IS NOT DISTINCT FROM spans.doc_id
"""


SQL = _sql()


def op8_license_join(spark, sf_dir: str) -> DataFrame:
    """License scan of the whole documents table."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
