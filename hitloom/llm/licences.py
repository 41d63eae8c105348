"""Licence scan by a positional rare-token index of licence templates.

Document frequencies over the whole corpus give the IDF of every word of the templates'
mandatory key phrases.  The index maps the two highest-IDF places of each key phrase to
(template, position).  Every such word of a text is looked up: its place minus its
position proposes where the template would begin, and a beginning that both of a
template's rare places propose survives the intersection.  There the whole key phrase must stand
word for word, and the share of template words found is the score.  A place with the key phrase
holds both rare words where they belong, so none is missed, however many templates a text holds.

Everything is DataFrame and SQL expressions on one row at a time; only the counts
of the fixed template words are shuffled.

Defined results
    words are runs of ASCII letters and digits and of all other characters beyond
    ASCII, A-Z lower-cased; null texts count as empty: no words, no labels, score 0;
    labels are distinct, sorted, comma-joined (none: empty string); repeated rows
    are scanned each; an empty table gives an empty result; other columns are
    carried along, and new columns whose names clash get a leading ``_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import fresh, text_or_empty

# A word, and the base phrases with their labels.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Templates (label, text, mandatory key phrase within the text).
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "except in compliance with the license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general public license"),
    ("cc-by", "licensed under cc by 4 0", "cc by"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify"),
]

#: Share of a template's words that must be found.
NEEDED = 0.6
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text_col: str) -> Column:
    return F.regexp_extract_all(F.translate(text_or_empty(text_col), _UPPER, _LOWER), F.lit(WORD), F.lit(0))


def _quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _array(items: list[str], kind: str) -> str:
    return f"CAST(array({', '.join(items)}) AS array<{kind}>)"


def rarest_first(docs: DataFrame, text_col: str, vocabulary: list[str]) -> list[str]:
    """``vocabulary`` by falling IDF over all rows of ``docs`` (one count per word reaches the driver)."""
    seen = docs.select(F.array_distinct(F.filter(words_of(text_col), lambda w: w.isin(vocabulary))).alias("seen"))
    counts = {r["w"]: r["n"] for r in seen.select(F.explode("seen").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def scan(docs: DataFrame, text_col: str = "text", templates: list[tuple[str, str, str]] = TEMPLATES, phrases: dict[str, str] = BASE_PHRASES) -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels, score and
    found (array of label, start, share: the templates found and where they begin)."""
    key_places = []  # for each template the places of its key phrase
    for _, text, key in templates:
        all_words, key_words = text.split(), key.split()
        at = next(i for i in range(len(all_words)) if all_words[i : i + len(key_words)] == key_words)
        key_places.append(range(at, at + len(key_words)))
    firsts = {p.split()[0] for p in phrases}
    vocabulary = sorted({w for _, _, key in templates for w in key.split()} | firsts)
    idf = {w: i for i, w in enumerate(rarest_first(docs, text_col, vocabulary))}
    # The two places of highest IDF (of a single word: that place, twice).
    rare = []
    for (_, text, _), places in zip(templates, key_places):
        by_idf = sorted(places, key=lambda p: (idf[text.split()[p]], p))
        rare.append((by_idf * 2)[:2])
    index = sorted({text.split()[p] for (_, text, _), places in zip(templates, rare) for p in places} | firsts, key=idf.get)
    place = {w: i for i, w in enumerate(index)}
    out = fresh(docs, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "found")
    words, hits, base, starts, agreed, found = fresh(docs.select("*", *[F.lit(0).alias(c) for c in out]), "words", "hits", "base", "starts", "agreed", "kept")

    # hits: (rank of the word, position) of every indexed word; the rank is its place in the IDF order
    ranks = _array([f"'{w}'" for w in index], "string")
    rows = docs.withColumn(words, words_of(text_col)).withColumn(hits, F.expr(
        f"transform(filter(transform({words}, (w, i) -> named_struct('w', w, 'i', i)), x -> x.w IN ({_quoted(index)})), "
        f"x -> named_struct('rank', CAST(array_position({ranks}, x.w) - 1 AS INT), 'i', x.i))"
    ))
    per_phrase = []
    for phrase, label in phrases.items():
        first, *rest = phrase.split()
        follows = " AND ".join([f"h.rank = {place[first]}", *[f"get({words}, h.i + {n}) = '{w}'" for n, w in enumerate(rest, 1)]])
        per_phrase.append(f"transform(filter({hits}, h -> {follows}), h -> named_struct('label', '{label}', 'i', h.i))")
    rows = rows.withColumn(base, F.expr(f"concat({', '.join(per_phrase)})"))

    # starts: template * 2^32 + proposed beginning + 2^31; agreed: proposed by both rare places
    postings: list[list[str]] = [[] for _ in index]
    for t, ((_, text, _), places) in enumerate(zip(templates, rare)):
        for p in places:
            postings[place[text.split()[p]]].append(f"{t * 2**32 + 2**31 - p}L")
    table = _array([_array(x, "bigint") for x in postings], "array<bigint>")
    rows = rows.withColumn(starts, F.expr(
        f"array_sort(flatten(transform({hits}, h -> transform(element_at({table}, h.rank + 1), p -> p + h.i))))"
    ))
    rows = rows.withColumn(agreed, F.expr(
        f"filter({starts}, (s, i) -> i > 0 AND s = get({starts}, i - 1) AND (i = 1 OR s != get({starts}, i - 2)))"
    ))
    texts = _array([_array([f"'{w}'" for w in text.split()], "string") for _, text, _ in templates], "array<string>")
    keys = _array([_array([f"'{w}'" for w in key.split()], "string") for _, _, key in templates], "array<string>")
    key_at = _array([str(places[0]) for places in key_places], "int")
    labels = _array([f"'{label}'" for label, _, _ in templates], "string")
    rows = rows.withColumn(agreed, F.expr(
        f"transform({agreed}, s -> named_struct('t', CAST(s DIV 4294967296 AS INT) + 1, 'at', CAST(s % 4294967296 - 2147483648 AS INT)))"
    ))
    # the key phrase word for word, then the share of the template's words that stand in their places
    phrase = f"slice({words}, s.at + element_at({key_at}, s.t) + 1, size(element_at({keys}, s.t))) = element_at({keys}, s.t)"
    rows = rows.withColumn(agreed, F.expr(f"filter({agreed}, s -> s.at + element_at({key_at}, s.t) >= 0 AND {phrase})"))
    share = f"size(filter(transform(element_at({texts}, s.t), (w, i) -> s.at + i >= 0 AND get({words}, s.at + i) = w), y -> y)) / size(element_at({texts}, s.t))"
    rows = rows.withColumn(found, F.expr(
        f"filter(transform({agreed}, s -> named_struct('label', element_at({labels}, s.t), 'start', s.at, 'share', CAST({share} AS DOUBLE))), x -> x.share >= {NEEDED})"
    ))
    join = lambda array: F.array_join(F.array_sort(F.array_distinct(array)), ",")
    some = F.size(base) > 0
    rows = rows.withColumns({
        out[0]: F.size(words).cast("long"), out[1]: F.size(base).cast("long"),
        out[2]: F.array_min(F.col(base)["i"]).cast("long"), out[3]: F.array_max(F.col(base)["i"]).cast("long"),
        out[4]: join(F.col(base)["label"]), out[5]: join(F.concat(F.col(base)["label"], F.col(found)["label"])),
        out[6]: F.greatest(F.coalesce(F.array_max(F.col(found)["share"]), F.lit(0.0)), F.when(some, F.lit(0.5)).otherwise(0.0)),
        out[7]: F.col(found),
    })
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], *out)
