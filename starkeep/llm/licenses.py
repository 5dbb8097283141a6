"""Licence notices in texts, by a positional index of rare words.

Base templates are key phrases; every place where one stands counts. A phrase is looked up by its word of highest
inverse document frequency in the corpus. The method's own templates are whole notices: of the places beside the key phrase, the third
(at most INDEXED) whose words have the highest inverse document frequency are postings ``word -> (template, place)``. A text's words are looked up
there; a hit at word i on place p says that the notice begins at i - p. Hits are intersected by that relative position, in windows of
two buckets of BUCKET words (so up to BUCKET words may be put in or lost). Where over half of a template's postings meet, its mandatory key
phrase must stand word by word in the same window; a phrase alone is never enough. Everything
happens within a row, in time linear in its words, so no shuffle holds texts; only word counts are gathered.
"""

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Postings of a template at most, and words of a bucket of beginnings.
INDEXED = 8
BUCKET = 16
#: Words of texts whose A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    """``words`` of a notice; the words from ``at`` to ``at + length`` are its key phrase."""

    label: str
    words: tuple[str, ...]
    at: int
    length: int
    base: bool = False

    @property
    def phrase(self) -> tuple[str, ...]:
        return self.words[self.at : self.at + self.length]

    @property
    def beside(self) -> list[int]:
        """Places outside the key phrase."""
        return [k for k in range(len(self.words)) if not self.at <= k < self.at + self.length]

    @property
    def postings(self) -> int:
        """How many of them are indexed: a third, so that common words stay out of short notices' postings."""
        return min(INDEXED, max(1, len(self.beside) // 3))

    @property
    def need(self) -> int:
        """Postings that must meet: over half."""
        return self.postings // 2 + 1


def template(label: str, notice: str, phrase: str, base: bool = False) -> Template:
    words, key = (tuple(re.findall(WORD, x.translate(str.maketrans(UPPER, LOWER)))) for x in (notice, phrase))
    at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
    return Template(label, words, at, len(key), base)


#: Base phrases are fixed by contract. The longer notices are those that the licences' authors ask to put into files.
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public"
    " License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version"
)
_CC = "This work is licensed under the Creative Commons {} 4.0 International License"
TEMPLATES = (
    template("mit", "released under the mit license", "mit license", True),
    template("apache", "licensed under the apache license version 2 0", "apache license", True),
    template("gpl", "licensed under the gnu general public license version 3", "general public license", True),
    template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
        " files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy,"
        " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "to deal in the software without restriction",
    ),
    template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
        " provided that the above copyright notice and this permission notice appear in all copies",
        "with or without fee is hereby granted",
    ),
    template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions"
        " and the following disclaimer",
        "redistribution and use in source and binary forms",
    ),
    template(
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed"
        " under the License is distributed on an AS IS BASIS",
        "apache org licenses license 2 0",
    ),
    template("gpl", _GNU.format("", "3"), "the gnu general public license"),
    template("lgpl", _GNU.format("Lesser ", "3"), "lesser general public license"),
    template("agpl", _GNU.format("Affero ", "3"), "affero general public license"),
    template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed"
        " with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
        "mozilla public license",
    ),
    template(
        "epl",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is"
        " available at https://www.eclipse.org/legal/epl-2.0",
        "eclipse public license",
    ),
    template(
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,"
        " sell, or distribute this software, either in source code form or as a compiled binary",
        "free and unencumbered software",
    ),
    template("cc-by", _CC.format("Attribution"), "creative commons attribution 4 0"),
    template("cc-by-sa", _CC.format("Attribution-ShareAlike"), "creative commons attribution sharealike"),
    template("cc-by-nc", _CC.format("Attribution-NonCommercial"), "creative commons attribution noncommercial 4 0"),
    template("cc-by-nd", _CC.format("Attribution-NoDerivatives"), "creative commons attribution noderivatives"),
    template("lgpl", "licensed under the gnu lesser general public license version 3", "lesser general public license"),
    template("agpl", "licensed under the gnu affero general public license version 3", "affero general public license"),
    template("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    template("epl", "under the terms of the eclipse public license", "eclipse public license"),
    template("bsd", "licensed under the bsd 3 clause license", "bsd 3 clause"),
    template("bsd", "licensed under the bsd 2 clause license", "bsd 2 clause"),
    template("bsd", "released under the bsd license", "bsd license"),
    template("isc", "released under the isc license", "isc license"),
    template("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    template("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    template("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0"),
)


def lowered(text: str = "text") -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def _array(values) -> Column:
    return F.array(*map(F.lit, values))


def document_frequencies(docs: DataFrame, templates=TEMPLATES) -> dict[str, int]:
    """In how many texts each word of the templates stands; words in none are missing. One row a word reaches the driver."""
    known = sorted({w for t in templates for w in t.words})
    held = docs.select(F.explode(F.array_intersect(words_of(lowered()), _array(known))).alias("word"))
    return dict(held.groupBy("word").count().collect())


def rarest(t: Template, frequency: dict[str, int]) -> list[int]:
    """The places of a template that are indexed: of least document frequency, ties by place."""
    return sorted(t.beside, key=lambda k: (frequency.get(t.words[k], 0), k))[: t.postings]


def _base_posting(t: Template, frequency: dict[str, int]) -> Column:
    """A base template under its rarest key word; ties go to the first."""
    at = min(range(t.length), key=lambda k: frequency.get(t.phrase[k], 0))
    return F.struct(
        F.lit(t.label).alias("label"),
        F.lit(t.phrase[at]).alias("rare"),
        F.lit(at).alias("offset"),
        F.lit(t.at).alias("ahead"),
        _array(t.phrase).alias("phrase"),
        _array(t.words).alias("words"),
    )


def _postings(own: list[Template], frequency: dict[str, int]) -> dict[str, list[tuple[int, int]]]:
    index = {}
    for number, t in enumerate(own):
        for at in rarest(t, frequency):
            index.setdefault(t.words[at], []).append((number, at))
    return index


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """``docs`` with what notices its texts hold.

    ``n_words``; ``n_base``, ``first_word`` and ``last_word``: how many places of base templates'
    key phrases there are, and the smallest and largest start (words from 0); ``base_labels`` and ``labels``: of base
    templates and of all, distinct, sorted, joined by commas; ``score``: the largest share of a base notice's words that stand in
    place around its key phrase, or of an own template's postings that meet beside its phrase; 0 without one. Null and
    empty texts have no words and no labels. Columns of these names are replaced; ids play no part, so repeated rows get equal results.
    """
    added = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    docs = docs.drop(*added, "_words", "_places", "_base", "_hits", "_own")
    frequency = document_frequencies(docs, templates)
    base = [t for t in templates if t.base]
    own = [t for t in templates if not t.base]
    base_postings = [_base_posting(t, frequency) for t in base]
    index = _postings(own, frequency)
    sought = sorted({*index, *(min(t.phrase, key=lambda w: frequency.get(w, 0)) for t in base)})
    words, places, hits = F.col("_words"), F.col("_places"), F.col("_hits")

    def stands(p, s):
        first = s.getField("i") - p.getField("offset")
        phrase = p.getField("phrase")
        return (s.getField("w") == p.getField("rare")) & (first >= 0) & (F.slice(words, F.greatest(first, F.lit(0)) + 1, F.size(phrase)) == phrase)

    def found(p, s):
        start = s.getField("i") - p.getField("offset")
        origin = start - p.getField("ahead")
        same = F.filter(
            p.getField("words"),
            lambda w, k: (origin + k >= 0) & F.coalesce(F.get(words, origin + k) == w, F.lit(False)),
        )
        share = F.size(same) / F.size(p.getField("words"))
        return F.struct(p.getField("label").alias("label"), start.alias("start"), share.alias("share"))

    numbered = F.transform(words, lambda w, i: F.struct(i.alias("i"), w.alias("w")))
    base_places = F.flatten(
        F.transform(F.array(*base_postings), lambda p: F.transform(F.filter(places, lambda s: stands(p, s)), lambda s: found(p, s)))
    ) if base else F.array().cast("array<struct<label:string,start:int,share:double>>")

    #: word -> its postings (template, place), as one literal map
    pairs = "array<struct<t:int,at:int>>"
    entries = [(F.lit(w), F.array(*(F.struct(F.lit(t), F.lit(at)) for t, at in at_places)).cast(pairs)) for w, at_places in index.items()]
    postings = F.create_map(*(x for entry in entries for x in entry)) if entries else F.create_map().cast(f"map<string,{pairs}>")
    none = F.array().cast(pairs)

    def windows(s, p):
        bucket = F.shiftright(s.getField("i") - p.getField("at"), BUCKET.bit_length() - 1)
        one = [F.struct(p.getField("t").alias("t"), b.alias("b"), p.getField("at").alias("at")) for b in (bucket - 1, bucket)]
        return F.array(*one)

    met = F.flatten(
        F.flatten(F.transform(places, lambda s: F.transform(F.coalesce(postings[s.getField("w")], none), lambda p: windows(s, p))))
    )
    facts = F.array(
        *(
            F.struct(
                F.lit(t.label).alias("label"), F.lit(t.need).alias("need"), F.lit(t.postings).alias("k"),
                F.lit(t.at).alias("at"), _array(t.phrase).alias("phrase"),
            )
            for t in own
        )
    ) if own else F.array().cast("array<struct<label:string,need:int,k:int,at:int,phrase:array<string>>>")

    def same(x, i):
        y = F.get(hits, i)
        return F.coalesce((y.getField("t") == x.getField("t")) & (y.getField("b") == x.getField("b")), F.lit(False))

    def meets(x, i):
        """The first hit of a window with enough others; the hits are sorted, so those lie behind it."""
        first = (i == 0) | ~same(x, F.greatest(i - 1, F.lit(0)))
        return first & same(x, i + F.get(facts, x.getField("t")).getField("need") - 1)

    def judged(x, i):
        fact = F.get(facts, x.getField("t"))
        votes = F.size(F.filter(F.sequence(F.lit(0), F.lit(INDEXED - 1)), lambda k: same(x, i + k)))
        low = x.getField("b") * BUCKET + fact.getField("at")
        phrase = fact.getField("phrase")
        held = F.exists(
            F.sequence(low, low + (2 * BUCKET - 1)),
            lambda s: (s >= 0) & (F.slice(words, F.greatest(s, F.lit(0)) + 1, F.size(phrase)) == phrase),
        )
        return F.struct(fact.getField("label").alias("label"), held.alias("held"), (votes / fact.getField("k")).alias("share"))

    kept = F.filter(F.transform(hits, lambda x, i: F.when(meets(x, i), judged(x, i))), lambda m: F.coalesce(m.getField("held"), F.lit(False)))

    def joined(found_labels):
        return F.array_join(F.array_sort(F.array_distinct(found_labels)), ",")

    nothing = F.array().cast("array<struct<i:int,w:string>>")
    listed = F.when(
        F.size(F.array_intersect(words, _array(sought))) > 0, F.filter(numbered, lambda s: s.getField("w").isin(sought))
    ).otherwise(nothing)
    return (
        docs.withColumn("_words", words_of(lowered()))
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("_places", listed)
        .withColumn("_base", base_places)
        .withColumn("_hits", F.sort_array(F.array_distinct(met)))
        .withColumn("_own", kept)
        .withColumn("n_base", F.size("_base").cast("long"))
        .withColumn("first_word", F.array_min("_base.start").cast("long"))
        .withColumn("last_word", F.array_max("_base.start").cast("long"))
        .withColumn("base_labels", joined(F.col("_base.label")))
        .withColumn("labels", joined(F.concat("_base.label", "_own.label")))
        .withColumn("score", F.coalesce(F.array_max(F.concat("_base.share", "_own.share")), F.lit(0.0)))
        .drop("_words", "_places", "_base", "_hits", "_own")
    )


def scan_sql(templates=TEMPLATES) -> str:
    """The same for DuckDB, from every place of every word."""

    def row(number, t):
        words = "[" + ", ".join(f"'{w}'" for w in t.words) + "]"
        return f"({number}, '{t.label}', {str(t.base).lower()}, {words}, {t.at}, {t.length}, {t.postings}, {t.need})"

    rows = ", ".join(row(k, t) for k, t in enumerate(templates))
    return rf"""
WITH t(t, label, base, words, ahead, size, k, need) AS (VALUES {rows}),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w
  FROM documents),
p AS (SELECT doc_id, w, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
tw AS (SELECT t, k, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS place, ahead, size FROM t WHERE NOT base),
df AS (SELECT word, count(DISTINCT doc_id) AS n FROM p WHERE word IN (SELECT word FROM tw) GROUP BY word),
postings AS (
  SELECT t, word, place FROM tw LEFT JOIN df USING (word)
  WHERE place < ahead OR place >= ahead + size
  QUALIFY row_number() OVER (PARTITION BY t ORDER BY coalesce(n, 0), place) <= k),
hits AS (
  SELECT DISTINCT doc_id, t, place, floor((i - 1 - place) / {BUCKET}.0)::BIGINT - back AS b
  FROM p JOIN postings USING (word) CROSS JOIN (VALUES (0), (1)) AS x(back)),
met AS (
  SELECT doc_id, t, b, count(*) AS votes FROM hits JOIN t USING (t) GROUP BY doc_id, t, b, need HAVING count(*) >= need),
own AS (
  SELECT met.doc_id, label, votes / k AS share FROM met JOIN t USING (t)
  WHERE EXISTS (
    SELECT 1 FROM p WHERE p.doc_id = met.doc_id AND p.word = t.words[ahead + 1]
      AND i - 1 - ahead BETWEEN b * {BUCKET} AND b * {BUCKET} + {2 * BUCKET - 1}
      AND w[i : i + size - 1] = words[ahead + 1 : ahead + size])),
m AS (
  SELECT doc_id, label, base, i - 1 AS start,
    list_sum([CASE WHEN i - ahead + k - 1 >= 1 AND w[i - ahead + k - 1] = words[k] THEN 1 ELSE 0 END
              FOR k IN range(1, len(words) + 1)]) / len(words) AS share
  FROM p JOIN t ON p.word = t.words[t.ahead + 1]
  WHERE base AND w[i : i + size - 1] = words[ahead + 1 : ahead + size]
  UNION ALL
  SELECT doc_id, label, false, NULL, share FROM own),
g AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
    max(start) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM m GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN g USING (doc_id)
"""
