"""Licence phrases by a positional index of their rare words.

Every template is known by the rarest words of its key phrase, rare by how few
of all documents hold them. A document's words are looked up in that small
index; each posting tells where the template would begin, places that all rare
words of a template agree on are verified against the key phrase, and the rest
of the template gives the score. All of it is column functions on the words of a
row: no exchange but the counts of the template words.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardspan.llm.words import lower_ascii

# Phrases and labels of the base.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# The method's templates, as (label, template, key phrase in it).
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted free of charge"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution and use in source and binary forms"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc0-1.0", "creative commons cc0 1 0 universal", "cc0 1 0"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)
#: Rare words of a key phrase that the index holds.
RARE = 2
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of letters, digits and all beyond ASCII, A-Z lower-cased; none for null."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.filter(parts, lambda w: w != "")


def _phrases() -> list[tuple[str, list[str], list[str], int, bool]]:
    """(label, template, key phrase, place of the key phrase, base) of all."""
    found = [(label, phrase.split(), phrase.split(), 0, True) for phrase, label in BASE.items()]
    for label, template, key in TEMPLATES:
        words, part = template.split(), key.split()
        place = next(k for k in range(len(words)) if words[k : k + len(part)] == part)
        found.append((label, words, part, place, False))
    return found


def rarity(words: DataFrame) -> dict[str, float]:
    """Inverse document frequency of every template word over ``words`` (words)."""
    known = sorted({w for _, template, _, _, _ in _phrases() for w in template})
    own = F.array_distinct(F.filter("words", lambda w: w.isin(known)))
    row = words.select(own.alias("own")).agg(
        F.count("*").alias("total"), *[F.count_if(F.array_contains("own", w)).alias(f"n{k}") for k, w in enumerate(known)]
    ).first()
    return {w: log((row["total"] + 1) / (row[f"n{k}"] + 1)) for k, w in enumerate(known)}


def _literal(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``<id_col>``, ``<text_col>``, n_words, places.

    ``places`` are structs (start, label, base, share): a key phrase stands where
    the template says it does when the template begins at word ``start``; for the
    base phrases ``share`` is 1, for templates the share of their words that
    stand in place. A template may begin before the text does; its words there
    count as absent. A null or empty text has no words and no places. Null ids
    and repeated rows are kept; other columns are ignored; an empty table gives
    no rows. Whole texts are read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    idf = rarity(rows.select(words_of(F.col("text")).alias("words")))
    phrases = _phrases()
    postings: dict[str, list[tuple[int, int]]] = {}
    needs = []
    for number, (_, _, key, place, _) in enumerate(phrases):
        rare = sorted(range(len(key)), key=lambda k: (-idf[key[k]], k))[:RARE]
        needs.append(len(rare))
        for k in rare:
            postings.setdefault(key[k], []).append((number, place + k))
    index = F.create_map(
        *[
            x
            for word, places in sorted(postings.items())
            for x in (F.lit(word), F.array(*[F.struct(F.lit(n).alias("t"), F.lit(k).alias("k")) for n, k in places]))
        ]
    )
    templates = F.array(
        *[
            F.struct(
                F.lit(label).alias("label"),
                _literal(template).alias("words"),
                _literal(key).alias("key"),
                F.lit(place).alias("place"),
                F.lit(base).alias("base"),
                F.lit(need).alias("need"),
            )
            for (label, template, key, place, base), need in zip(phrases, needs)
        ]
    )
    rare = sorted(postings)
    spots = F.filter(
        F.transform("words", lambda w, i: F.when(w.isin(rare), i)), lambda i: i.isNotNull()
    )
    starts = F.flatten(
        F.transform(
            "spots",
            lambda i: F.transform(
                F.element_at(index, F.get("words", i)), lambda p: F.struct(p.t.alias("t"), (i - p.k).alias("start"))
            ),
        )
    )

    def template(c: Column) -> Column:
        return F.element_at("templates", c.t + 1)

    def verified(c: Column, i: Column) -> Column:
        own = template(c)
        # Equal starts stand together: of each run the first, if the run is as long as the rare words are many.
        first = (i == 0) | (F.get("starts", i - 1) != c)
        agreed = first & F.coalesce(F.get("starts", i + own.need - 1) == c, F.lit(False))
        at = c.start + own.place
        return agreed & (at >= 0) & (F.slice("words", F.greatest(at, F.lit(0)) + 1, F.size(own.key)) == own.key)

    def share(c: Column) -> Column:
        own = template(c)
        stands = F.transform(own.words, lambda w, k: F.when((c.start + k >= 0) & (F.get("words", c.start + k) == w), 1.0).otherwise(0.0))
        return F.aggregate(stands, F.lit(0.0), lambda a, b: a + b) / F.size(own.words)

    places = F.transform(
        F.filter("starts", verified),
        lambda c: F.struct(
            c.start.cast("long").alias("start"), template(c).label.alias("label"), template(c).base.alias("base"), share(c).alias("share")
        ),
    )
    found = (
        rows.withColumn("words", words_of(F.col("text")))
        .withColumn("spots", spots)
        .withColumn("starts", F.array_sort(starts))
        .withColumn("templates", templates)
    )
    return found.select(
        F.col("id").alias(id_col),
        F.col("text").alias(text_col),
        F.size("words").cast("long").alias("n_words"),
        F.array_sort(places).alias("places"),
    )
