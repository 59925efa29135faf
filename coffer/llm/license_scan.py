"""Licence scan by a positional index of rare licence words. DataFrame functions only.

A template is a passage that a licence text or notice always words alike, with key phrases that must stand in it. Its
rarest words, by inverse document frequency over the whole corpus, are the index: word -> (template, position). A file
looks up the indexed words that it holds; each gives the place where the template would begin, and places that two
rare words agree on are candidates. There the words of the template are compared one by one: enough of them, and all
those of its key phrases, must stand at their relative positions.

The index loses no place. A template of ``n`` words that needs ``m`` of them at their positions keeps its ``n - m + 2``
rarest positions; a place with ``m`` right words has at least two of those right. Which words are rarest decides only how
many candidates are looked at. A phrase is a template that needs all its words.

A text is worked on in its own row: the only shuffle is the count of documents per licence word, added up before it. The
templates are a parameter and travel in the plan as a constant; they do not grow with the data.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.llm.common import documents, text_of

#: Share of a passage's words that must stand at their positions.
SHARE = 0.8
#: Words that must agree on a place before it is compared.
VOTES = 2
#: Fixed value: words, once A-Z is lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words, named by what they hold; faster to match.
LETTERS = r"[0-9a-z\x{80}-\x{10FFFF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_in(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


@dataclass(frozen=True)
class Template:
    """A passage of at least two words; ``share`` of them, and every word of the key phrases, stand at their positions."""

    label: str
    text: str
    share: float = 1.0
    keys: tuple[str, ...] = ()
    base: bool = False

    @property
    def words(self) -> list[str]:
        return words_in(self.text)

    @property
    def least(self) -> int:
        return max(VOTES, math.ceil(self.share * len(self.words) - 1e-9))

    @property
    def required(self) -> list[int]:
        """Positions of the key phrases, at their first place in the passage."""
        words, found = self.words, set()
        for key in map(words_in, self.keys):
            starts = [i for i in range(len(words)) if words[i:i + len(key)] == key]
            if not starts:
                raise ValueError(f"the key phrase {key} is not in the template {self.label}")
            found.update(range(starts[0], starts[0] + len(key)))
        return sorted(found)


#: The phrases and labels that every result has.
BASE = (
    Template("cc-by", "cc by", base=True),
    Template("gpl", "general public license", base=True),
    Template("reserved", "all rights reserved", base=True),
)

#: Names of licences and passages of their notices, as published.
PUBLIC = (
    Template("agpl", "gnu affero general public license"),
    Template("apache-2.0", "apache license version 2 0"),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the "
             "license at", SHARE, ("in compliance with the license",)),
    Template("boost-1.0", "boost software license version 1 0"),
    Template("bsd", "bsd license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
             "that the following conditions are met", SHARE, ("source and binary forms",)),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc0", "cc0 1 0 universal"),
    Template("creative-commons", "creative commons attribution"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
             "general public license as published by the free software foundation", SHARE, ("gnu general public license",)),
    Template("gpl-2.0", "gnu general public license version 2"),
    Template("gpl-3.0", "gnu general public license version 3"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
             "hereby granted", SHARE, ("with or without fee",)),
    Template("lgpl", "gnu lesser general public license"),
    Template("mit", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
             "associated documentation files", SHARE, ("free of charge",)),
    Template("mpl-2.0", "mozilla public license"),
    Template("public-domain", "released into the public domain"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", SHARE,
             ("free and unencumbered software",)),
)


def _words(text: Column) -> Column:
    """Words of a text. Only A-Z is lower-cased: ``lower`` does that alone where all characters are ASCII."""
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0))


def rarity(docs: DataFrame, templates: Sequence[Template]) -> dict[str, float]:
    """Inverse document frequency over all ``docs`` of each word of the templates."""
    vocabulary = sorted({w for t in templates for w in t.words})
    held = docs.select(F.array_intersect(F.lit(vocabulary), _words(text_of())).alias("held"))
    counts = held.select(F.explode_outer("held").alias("word")).groupBy("word").count()
    # documents without any licence word matter to no word's order; the number of the others scales all alike
    found = {r["word"]: r["count"] for r in counts.collect()}
    most = max(found.values(), default=0)
    return {w: math.log((most + 1) / (found.get(w, 0) + 1)) for w in vocabulary}


def rare_index(templates: Sequence[Template], idf: dict[str, float]) -> dict[str, list[dict]]:
    """Postings of each template's rarest positions: word -> [(template, position)]."""
    index: dict[str, list[dict]] = {}
    for number, template in enumerate(templates):
        words = template.words
        if len(words) < VOTES:
            raise ValueError(f"a template needs {VOTES} words: {template.text!r}")
        rarest = sorted(range(len(words)), key=lambda i: (-idf[words[i]], i))[: len(words) - template.least + VOTES]
        for position in sorted(rarest):
            index.setdefault(words[position], []).append({"template": number, "at": position})
    return index


def _constant(value, schema: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), schema)


def _upto(n: Column, first: int = 0) -> Column:
    """first, ..., n - 1; empty where there is none."""
    return F.when(n > first, F.sequence(F.lit(first), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, templates: Sequence[Template] = (*BASE, *PUBLIC)) -> DataFrame:
    """One row per document: doc_id, n_words, and ``places``, all places of templates in the text.

    A place is (template, label, base, start, matched, share): ``start`` is the word, from 0, at which the template's
    first word stands or, where the text begins within the passage, would stand (below 0); ``share`` is the share of its
    words that stand at their positions. Places are ordered by template and start. Null and empty texts have no words
    and no places. Rows that repeat an id or a text are scanned each by itself; a null id stays null. An empty table
    gives no rows. Other columns are not read, whatever their names.
    """
    index = rare_index(templates, rarity(docs, templates))
    table = _constant(
        [{"words": t.words, "required": t.required, "least": t.least, "label": t.label, "base": t.base} for t in templates],
        "array<struct<words:array<string>,required:array<int>,least:int,label:string,base:boolean>>",
    )
    postings = _constant(index, "map<string,array<struct<template:int,at:int>>>")
    rare = list(index)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _words(text_of()).alias("words"))
    rows = rows.select("doc_id", "words", F.size("words").cast("long").alias("n_words"))
    held = F.filter(_upto(F.size("words")), lambda i: F.get("words", i).isin(rare))
    begins = F.transform(held, lambda i: F.transform(
        F.element_at(postings, F.get("words", i)),
        lambda p: F.struct(p["template"].alias("template"), (i - p["at"]).alias("start")),
    ))
    rows = rows.select("*", F.array_sort(F.flatten(begins)).alias("begins"))

    def same(k: Column, back: int) -> Column:
        return F.get("begins", k).eqNullSafe(F.get("begins", k - back))

    agreed = F.filter(_upto(F.size("begins"), 1), lambda k: same(k, 1) & ~same(k, 2))

    def compared(k: Column) -> Column:
        at = F.get("begins", k)
        template = F.get(table, at["template"])
        stands = lambda j: F.get("words", at["start"] + j).eqNullSafe(F.get(template["words"], j))
        return F.struct(
            at["template"].alias("template"), at["start"].alias("start"),
            F.size(F.filter(_upto(F.size(template["words"])), stands)).alias("matched"),
            F.forall(template["required"], stands).alias("keyed"),
        )

    rows = rows.select("doc_id", "n_words", F.transform(agreed, compared).alias("compared"))

    def place(c: Column) -> Column:
        template = F.get(table, c["template"])
        return F.struct(
            c["template"].alias("template"), template["label"].alias("label"), template["base"].alias("base"),
            c["start"].alias("start"), c["matched"].alias("matched"),
            (c["matched"] / F.size(template["words"])).alias("share"),
        )

    accepted = F.filter("compared", lambda c: c["keyed"] & (c["matched"] >= F.get(table, c["template"])["least"]))
    return rows.select("doc_id", "n_words", F.transform(accepted, place).alias("places"))


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every document; the score is the largest share of a template found, else 0."""
    found = scan(documents(spark, sf_dir)).select("doc_id", "n_words", "places", F.filter("places", lambda p: p["base"]).alias("base"))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").cast("long").alias("first_word"), F.array_max("base.start").cast("long").alias("last_word"),
        _joined(F.col("base.label")).alias("base_labels"), _joined(F.col("places.label")).alias("labels"),
        F.coalesce(F.array_max("places.share"), F.lit(0.0)).alias("score"),
    )


def _template_rows() -> str:
    return ", ".join(
        f"({number}, '{t.label}', {t.base}, {len(t.words)}, {t.least}, {len(t.required)}, {at}, '{word}', {at in t.required})"
        for number, t in enumerate((*BASE, *PUBLIC)) for at, word in enumerate(t.words)
    )


SQL = {
    "op11_license_scan": rf"""
        WITH template(number, label, base, n, least, n_required, pos, word, required) AS (VALUES {_template_rows()}),
        texts AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words
            FROM documents),
        placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS i FROM texts),
        places AS (
            SELECT doc_id, number, label, base, i - pos AS start, count(*) / n AS share
            FROM placed JOIN template USING (word)
            GROUP BY doc_id, number, label, base, n, least, n_required, i - pos
            HAVING count(*) >= least AND count(*) FILTER (WHERE required) = n_required),
        summed AS (
            SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word,
                   max(start) FILTER (WHERE base) AS last_word, max(share) AS score,
                   string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
                   string_agg(DISTINCT label, ',' ORDER BY label) AS labels
            FROM places GROUP BY doc_id)
        SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
               CAST(coalesce(score, 0) AS DOUBLE) AS score
        FROM texts LEFT JOIN summed USING (doc_id)
    """,
}
