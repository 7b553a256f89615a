"""Licence scan with a positional index of rare words.

Method. Licence texts are templates: sequences of words with a label, of which short phrases must occur word for word. The corpus
tells how rare each licence word is. For every document the rarest words it has of each template (and each phrase's rarest word) are looked up in the
templates' postings; a word at place i of the document and place j of a template says that the template may begin at i - j. Places
that enough rare weight agrees on are candidates, and a candidate counts if all words of its mandatory phrase stand
at their places and ``LEAST_SHARE`` of the template's weight does. A base phrase is a template that is mandatory as a whole.

Documents are read once, into a table of the places of licence words; rows carry a number of their own, so every later step works on
that table by row and place, and no key is larger than one document's part of it. Templates are a few hundred words, fixed by a
parameter, which is what bounds the side that is broadcast.

Defined results: a null text is empty, has no words and no labels (empty strings, score 0, null places); places of one phrase may
overlap and all count; rows that repeat an id are scanned each by itself; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_spark.llm.common import NO_WORD, ascii_words, written

#: Rarest words looked up for each document and template; shares of a template's weight for a candidate and for a match.
RAREST, CANDIDATE_SHARE, LEAST_SHARE = 6, 0.25, 0.6
#: Function words that templates do not index.
UNINDEXED = frozenset("a an and are as be for in is it may not of on or that the this to under we with without you".split())

#: Base phrases with their labels (fixed values).
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Opening words of public licences: label, text, the phrase that must occur.
TEXTS = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files to deal in the software without restriction", "permission is hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "redistribution and use in source and binary forms"),
    ("apache", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license",
     "apache license version 2 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation", "free software you can redistribute it"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
     "public license as published by the free software foundation", "gnu lesser general public license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     "copy modify and or distribute this software"),
    ("cc-by", "this work is licensed under a creative commons attribution international license", "creative commons attribution"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
)


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    mandatory: tuple[int, int]  # the first place and the place after the last of the phrase that must occur
    base: bool

    @property
    def phrase(self) -> list[tuple[int, str]]:
        """The words of the mandatory phrase, function words included."""
        return [(i, self.words[i]) for i in range(*self.mandatory)]

    @property
    def indexed(self) -> list[tuple[int, str]]:
        return [(i, w) for i, w in enumerate(self.words) if self.base or w not in UNINDEXED]


def words_of(text: str) -> tuple[str, ...]:
    return tuple(w for w in re.split(NO_WORD, text.lower()) if w)


def templates(base: Sequence[tuple[str, str]] = BASE, texts: Sequence[tuple[str, str, str]] = TEXTS) -> list[Template]:
    out = [Template(label, words_of(phrase), (0, len(words_of(phrase))), True) for phrase, label in base]
    for label, text, phrase in texts:
        words, key = words_of(text), words_of(phrase)
        at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        out.append(Template(label, words, (at, at + len(key)), False))
    return out


def scan(docs: DataFrame, known: Sequence[Template] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``."""
    known = templates() if known is None else known
    places = places_of_licence_words(docs, known, id_col, text_col)
    counted = places.select(F.explode(F.array_distinct("places.word")).alias("word")).groupBy("word").count()
    frequency = dict(map(tuple, counted.collect()))  # a row for each word of the templates
    idf = idf_of(known, frequency, places.count())
    found = verified(places, candidates(places, known, idf), known, idf)
    is_base = F.when(F.col("base"), F.col("at"))
    labels = found.groupBy("row").agg(
        F.count(is_base).alias("n_base"), F.min(is_base).alias("first_word"), F.max(is_base).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("share").alias("score"),
    )
    return places.select("row", "doc_id", "n_words").join(labels, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"), F.col("first_word").cast("bigint"),
        F.col("last_word").cast("bigint"), F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def idf_of(known: Sequence[Template], frequency: dict[str, int], n: int) -> dict[str, float]:
    import math

    words = {w for t in known for _, w in t.indexed}
    return {w: math.log((n + 2) / (frequency.get(w, 0) + 1)) for w in words}


def places_of_licence_words(docs: DataFrame, known: Sequence[Template], id_col: str, text_col: str) -> DataFrame:
    """For each document its number of words and the places of those that a template has; ``others`` are the places of function words
    of mandatory phrases, which are read for verification only."""
    vocabulary = sorted({w for t in known for _, w in t.indexed})
    small = sorted({w for t in known for _, w in t.phrase}.difference(vocabulary))
    tokens = docs.select(F.col(id_col).alias("doc_id"), ascii_words(F.col(text_col)).alias("words"))

    def placed(among: list[str]) -> Column:
        found = F.transform("words", lambda word, i: F.when(word.isin(among), F.struct(word.alias("word"), i.alias("at"))))
        return F.filter(found, lambda place: place.isNotNull())

    rows = tokens.select("doc_id", "words", F.size("words").cast("bigint").alias("n_words"), placed(vocabulary).alias("places"))
    others = F.when(F.size("places") > 0, placed(small)) if small else F.lit(None).cast(rows.schema["places"].dataType)
    rows = rows.select("doc_id", "n_words", "places", others.alias("others"))
    return written(rows.select(F.monotonically_increasing_id().alias("row"), "*"), "licence-places")


def postings(spark: SparkSession, known: Sequence[Template], idf: dict[str, float], whole_phrases: bool = False) -> DataFrame:
    """A row for each indexed word of each template; for verification also for the function words of its phrase, without weight."""
    rows = [
        (number, word, at, idf[word] if (at, word) in t.indexed else 0.0, t.mandatory[0] <= at < t.mandatory[1])
        for number, t in enumerate(known) for at, word in sorted({*t.indexed, *(t.phrase if whole_phrases else ())})
    ]
    return F.broadcast(spark.createDataFrame(rows, "template int, word string, place int, idf double, mandatory boolean"))


def totals(known: Sequence[Template], idf: dict[str, float]) -> dict[int, float]:
    return {number: sum(idf[w] for _, w in t.indexed) for number, t in enumerate(known)}


def by_template(values: dict[int, object]) -> Column:
    """The value of the row's template."""
    return F.element_at(F.array(*(F.lit(values[i]) for i in range(len(values)))), F.col("template") + 1)


def candidates(places: DataFrame, known: Sequence[Template], idf: dict[str, float]) -> DataFrame:
    """Where each template may begin (``row, template, at``), by the places of rare words."""
    order = sorted(idf, key=lambda w: (-idf[w], w))
    anchors = {min((w for _, w in t.indexed), key=order.index) for t in known if t.base}
    ranked = F.array(*(F.array(*(F.lit(w) for w in sorted({w for _, w in t.indexed}, key=order.index))) for t in known))
    own = F.array_distinct(F.col("places.word"))
    rare = F.flatten(F.transform(ranked, lambda words: F.slice(F.filter(words, lambda w: F.array_contains(own, w)), 1, RAREST)))
    looked_up = places.where(F.size("places") > 0).select("row", "places", F.array_union(rare, F.array(*map(F.lit, sorted(anchors)))).alias("rare"))
    kept = F.filter("places", lambda p: F.array_contains(F.col("rare"), p["word"]))
    hits = looked_up.select("row", F.explode(kept).alias("p")).select("row", "p.word", "p.at")
    posted = postings(places.sparkSession, known, idf).withColumn("anchor", F.col("word").isin(sorted(anchors)))
    met = hits.join(posted, "word").where("at >= place")
    agreed = met.groupBy("row", "template", (F.col("at") - F.col("place")).alias("at")).agg(
        F.sum("idf").alias("weight"), F.max("anchor").alias("anchor"))
    enough = F.col("weight") >= by_template(totals(known, idf)) * CANDIDATE_SHARE
    base = by_template({i: t.base for i, t in enumerate(known)})
    return agreed.where(F.when(base, F.col("anchor")).otherwise(enough)).select("row", "template", "at")


def verified(places: DataFrame, tried: DataFrame, known: Sequence[Template], idf: dict[str, float]) -> DataFrame:
    """Candidates whose mandatory phrase stands whole, word by word: ``row, at, label, base, share``."""
    spark = places.sparkSession
    wanted = tried.join(postings(spark, known, idf, True), "template").withColumn("stands", F.col("at") + F.col("place"))
    every = F.concat("places", F.coalesce("others", F.array().cast(places.schema["places"].dataType)))
    there = places.join(tried.select("row").distinct(), "row", "left_semi").select("row", F.explode(every).alias("p"))
    there = there.select("row", F.col("p.word").alias("word"), F.col("p.at").alias("stands"))
    met = wanted.join(there, ["row", "word", "stands"])
    summed = met.groupBy("row", "template", "at").agg(F.sum("idf").alias("weight"), F.count_if("mandatory").alias("kept"))
    needed = {i: len(t.phrase) for i, t in enumerate(known)}
    full = {i: max(x, 1e-9) for i, x in totals(known, idf).items()}
    share = F.least(F.col("weight") / by_template(full), F.lit(1.0))
    base = by_template({i: t.base for i, t in enumerate(known)})
    ok = (F.col("kept") == by_template(needed)) & (base | (share >= LEAST_SHARE))
    label = by_template({i: t.label for i, t in enumerate(known)})
    return summed.where(ok).select("row", "at", label.alias("label"), base.alias("base"), F.when(base, 1.0).otherwise(share).alias("share"))
