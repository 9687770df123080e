"""Licence scan by a positional index of rare licence words.

Templates are short licence statements with a key phrase that must be there, word for word.
The document frequency of every template word is counted over the whole table. A template's
rarest words are its probes, kept in an index ``word -> (template, position)``. Each text
looks up the places of probe words only; a place and a posting give where the template would
begin, and places that agree on it vote together. Then the key phrase is verified there, and
the share of the template's weight that stands in its place is the score. A phrase that must
be found everywhere is a template that is its own key: its rarest word stands in each of its
places, so none is missed.

Only SQL functions: every text is handled in its own row and nothing but word counts is
shuffled, so neither a hot source nor a very common licence line gathers in a task.

Defined results: a null text has no words, no labels and score 0; equal rows get equal
results; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import session

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Label, statement, key phrase.
BASE = [
    ("mit", "mit license", "mit license"),
    ("apache", "apache license", "apache license"),
    ("gpl", "general public license", "general public license"),
]
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of "
     "this software and associated documentation files", "permission is hereby granted free of charge"),
    ("gpl-3.0", "licensed under the gnu general public license version 3",
     "general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2",
     "general public license version 2"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("agpl", "gnu affero general public license", "affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
     "permitted", "redistribution and use in source and binary forms"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license",
     "creative commons attribution 4 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or "
     "without fee is hereby granted", "permission to use copy modify and or distribute"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "unencumbered software released into the public domain"),
]
PROBES = 3


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in lower case; a null text has none."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def has_any(text: Column, words: list[str]) -> Column:
    """Whether a text may hold one of the words: cheap, and never wrong when it says no."""
    return F.coalesce(text, F.lit("")).rlike("(?i)" + "|".join(map(re.escape, words)))


def frequencies(docs: DataFrame, vocabulary: list[str], text: str = "text") -> dict[str, int]:
    """Number of texts that hold each licence word: at most as many rows as the vocabulary."""
    known = F.array(*map(F.lit, vocabulary))
    seen = docs.select(F.explode(F.array_intersect(words_of(F.col(text)), known)).alias("word"))
    return {r["word"]: r["n"] for r in seen.groupBy("word").agg(F.count("*").alias("n")).collect()}


def scan(docs: DataFrame, base=BASE, templates=TEMPLATES, text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``."""
    session(docs.sparkSession)
    every = [(*t, True) for t in base] + [(*t, False) for t in templates]
    vocabulary = sorted({w for _, body, _, _ in every for w in body.split()})
    seen = frequencies(docs, vocabulary, text)
    weight = {w: -math.log((seen.get(w, 0) + 1) / (max([*seen.values(), 1]) + 2)) for w in vocabulary}

    postings, facts = [], []
    for number, (label, body, key, is_base) in enumerate(every, 1):
        words, key_words = body.split(), key.split()
        offset = next(i for i in range(len(words)) if words[i : i + len(key_words)] == key_words)
        # The rarest key word finds every place; further probes only add votes.
        chosen = [min(key_words, key=lambda w: (-weight[w], w))]
        rarest = sorted({*words} - {*chosen}, key=lambda w: (-weight[w], w))
        chosen += rarest[: 0 if is_base else PROBES - 1]
        postings += [(w, number, i) for i, w in enumerate(words) if w in chosen]
        facts.append(F.struct(
            F.lit(label).alias("label"), F.lit(is_base).alias("base"),
            F.array(*map(F.lit, words)).alias("words"),
            F.array(*[F.lit(weight[w]) for w in words]).alias("weights"),
            F.lit(offset).alias("offset"), F.array(*map(F.lit, key_words)).alias("key"),
        ))
    index = F.array(*[
        F.struct(F.lit(w).alias("word"), F.lit(t).alias("t"), F.lit(p).alias("p"))
        for w, t, p in postings
    ])
    known = F.array(*facts)
    probes = sorted({w for w, _, _ in postings})

    words = F.col("words")
    places = F.filter(
        F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("i"))),
        lambda s: s["word"].isin(probes),
    )
    begins = F.flatten(F.transform(F.col("places"), lambda s: F.transform(
        F.filter(index, lambda q: q["word"] == s["word"]),
        lambda q: F.struct(q["t"].alias("t"), (s["i"] - q["p"]).alias("start")),
    )))

    def verified(c: Column) -> Column:
        fact = F.element_at(known, c["t"])
        first = c["start"] + fact["offset"]
        return (first >= 0) & (
            F.slice(words, F.greatest(first, F.lit(0)) + 1, F.size(fact["key"])) == fact["key"]
        )

    def strength(c: Column) -> Column:
        fact = F.element_at(known, c["t"])
        stands = F.transform(fact["words"], lambda w, i: F.when(
            F.coalesce(F.get(words, c["start"] + i) == w, F.lit(False)),
            F.element_at(fact["weights"], i + 1),
        ).otherwise(0.0))
        total = F.aggregate(fact["weights"], F.lit(0.0), lambda a, x: a + x)
        return F.aggregate(stands, F.lit(0.0), lambda a, x: a + x) / F.greatest(total, F.lit(1e-9))

    def labels(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(
            F.transform(found, lambda c: F.element_at(known, c["t"])["label"])
        )), ",")

    found = F.col("found")
    is_base = F.filter(found, lambda c: F.element_at(known, c["t"])["base"])
    starts = F.transform(F.col("in_base"), lambda c: c["start"].cast("long"))
    none = F.array().cast("array<struct<word:string,i:int>>")
    rows = docs.select(
        "doc_id", words_of(F.col(text)).alias("words"), has_any(F.col(text), probes).alias("may")
    )
    rows = rows.withColumn("places", F.when(F.col("may"), places).otherwise(none))
    rows = rows.withColumn("begins", F.array_distinct(begins))
    rows = rows.withColumn("found", F.filter(F.col("begins"), verified))
    rows = rows.withColumn("in_base", is_base)
    score = F.coalesce(F.array_max(F.transform(found, strength)), F.lit(0.0))
    return rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.size("in_base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(F.col("in_base")).alias("base_labels"),
        labels(found).alias("labels"),
        F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)).alias("score"),
        F.size("places").cast("long").alias("n_probes"),
    )
