"""License scan: Dice coefficient over word bigrams against license templates.

A text is cut into units: sentences, lines of several sentences and
paragraphs (up to a blank line) of several lines. A unit's set of word
bigrams A matches a template's set B when 2 |A and B| / (|A| + |B|) reaches
``THRESHOLD``. That needs |A| between |B| t / (2 - t) and |B| (2 - t) / t, so
units outside the bounds of every template are dropped before their bigrams
are made rows, and a bigram meets only templates whose bounds allow its unit.
The meeting is an equality join with the templates' bigrams, a table fixed by
TEMPLATES, so texts are not shuffled.

A match shares at least |B| t / (2 - t) of a template's bigrams. If fewer than
that lack every one of some keywords, a matching text has a keyword; so a text
without any keyword of the templates is not cut up at all.

Only DataFrame functions are used.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valorem.llm.common import UPPER, ascii_lower, table, with_body

THRESHOLD = 0.8
SHORT_WORD = 6

# License identifiers and the texts that name or grant them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            "above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

PARAGRAPH = r"\n[ \t\r]*\n"
SENTENCE = r"[.!?;][ \t\r]+"
#: What parts words: all ASCII but letters and digits. (Texts are lower-cased before.)
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def keywords(templates, threshold: float = THRESHOLD) -> list[str]:
    """Words of which every text that matches a template has one. Long words are preferred: few other texts have them."""
    out: set[str] = set()
    for _, text in templates:
        own = [w for w in re.split(APART, text.translate(str.maketrans(UPPER, UPPER.lower()))) if w]
        pairs = set(zip(own, own[1:]))
        needed = math.ceil(len(pairs) * threshold / (2 - threshold) - 1e-9)
        while len(left := [p for p in pairs if not out.intersection(p)]) >= needed:
            out.add(max(set(own), key=lambda w: (sum(w in p for p in left) * (1 if len(w) >= SHORT_WORD else 0.05), len(w), w)))
    return sorted(out)


def has_keyword(low, words: list[str]):
    """Short words must stand alone; long ones are looked for anywhere."""
    short = [w for w in words if len(w) < SHORT_WORD]
    tests = [F.contains(low, F.lit(w)) for w in words if len(w) >= SHORT_WORD]
    if short:
        tests.append(low.rlike(f"(?<![a-z0-9])(?:{'|'.join(short)})(?![a-z0-9])"))
    return reduce(or_, tests)


def nested_words(text):
    """Paragraphs of lines of sentences of words of a lower-cased text; whatever has no word is left out."""
    def sentences(line):
        return F.filter(F.transform(F.split(line, SENTENCE), lambda s: F.array_remove(F.split(s, APART), "")), lambda w: F.size(w) > 0)

    def lines(paragraph):
        return F.filter(F.transform(F.split(paragraph, "\n"), sentences), lambda x: F.size(x) > 0)

    return F.filter(F.transform(F.split(text, PARAGRAPH), lines), lambda x: F.size(x) > 0)


def units(nested):
    """Word arrays of the sentences, of lines of two sentences or more, of paragraphs of two lines or more."""
    return F.concat(
        F.flatten(F.flatten(nested)),
        F.transform(F.filter(F.flatten(nested), lambda x: F.size(x) > 1), F.flatten),
        F.transform(F.filter(nested, lambda x: F.size(x) > 1), lambda x: F.flatten(F.flatten(x))))


def bigrams(words):
    """The set of neighbouring pairs."""
    return F.array_distinct(F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1),
                                       lambda a, b: F.concat(a, F.lit(" "), b)))


def _once(column):
    """The column as a row of its own: what follows reads the value instead of repeating the expression."""
    return F.explode(F.array(column))


def template_bigrams(spark, templates=None, threshold: float = THRESHOLD) -> DataFrame:
    """template, license, bigram, size, low, high: a few hundred rows, fixed by the templates."""
    rows = [(i, license_id, text) for i, (license_id, text) in enumerate(TEMPLATES if templates is None else templates)]
    own = (spark.createDataFrame(rows, "template int, license string, text string")
           .withColumn("text", F.translate("text", UPPER, UPPER.lower()))
           .withColumn("set", bigrams(F.array_remove(F.split("text", APART), ""))).withColumn("size", F.size("set")))
    share = threshold / (2 - threshold)
    return own.select("template", "license", "size", F.ceil(F.col("size") * share - 1e-9).alias("low"),
                      F.floor(F.col("size") / share + 1e-9).alias("high"), F.explode("set").alias("bigram"))


def matches(docs: DataFrame, templates=None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, body (hash of the text), unit (its number in the text), template, license, dice: every match."""
    words = keywords(TEMPLATES if templates is None else templates, threshold)
    wanted = template_bigrams(docs.sparkSession, templates, threshold)
    sizes = wanted.agg(F.min("low"), F.max("high")).first()
    if sizes[0] is None:
        raise ValueError("no template has two words")
    own = (with_body(docs.select("doc_id", "text"))
           .select("doc_id", "body", _once(ascii_lower(F.col("text"))).alias("low"))
           .filter(has_keyword(F.col("low"), words))
           .select("doc_id", "body", _once(nested_words(F.col("low"))).alias("nested"))
           .select("doc_id", "body", F.posexplode(units(F.col("nested"))).alias("unit", "words"))
           .filter(F.size("words") > int(sizes[0]))
           .select("doc_id", "body", "unit", _once(bigrams(F.col("words"))).alias("set"))
           .filter(F.size("set").between(int(sizes[0]), int(sizes[1])))
           .select("doc_id", "body", "unit", F.size("set").alias("n"), F.explode("set").alias("bigram")))
    # Rows that repeat a document bring each bigram as often as they are, hence the distinct count.
    met = own.join(F.broadcast(wanted), "bigram").filter(F.col("n").between(F.col("low"), F.col("high")))
    shared = met.groupBy("doc_id", "body", "unit", "n", "template", "license", "size").agg(F.count_distinct("bigram").alias("both"))
    return (shared.withColumn("dice", 2.0 * F.col("both") / (F.col("n") + F.col("size"))).filter(F.col("dice") >= threshold)
            .select("doc_id", "body", "unit", "template", "license", "dice"))


def scan(docs: DataFrame, templates=None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_matches (units that match), licenses (sorted, comma-joined), best_dice: one row per input row.

    Null and empty texts, and texts without a match, have 0, '' and 0.0. Ties
    between templates give each license once. Other columns are ignored.
    """
    found = (matches(docs, templates, threshold).groupBy("doc_id", "body")
             .agg(F.count_distinct("unit").alias("n_matches"), F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
                  F.max("dice").alias("best_dice"))
             .select(F.col("doc_id").alias("_id"), F.col("body").alias("_body"), "n_matches", "licenses", "best_dice"))
    own = with_body(docs.select("doc_id", "text")).select("doc_id", "body")
    return (own.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("body") == F.col("_body")), "left")
            .select("doc_id", F.coalesce("n_matches", F.lit(0)).alias("n_matches"), F.coalesce("licenses", F.lit("")).alias("licenses"),
                    F.coalesce("best_dice", F.lit(0.0)).alias("best_dice")))


def op2_license_scan(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    values = ",\n    ".join("({}, '{}', '{}')".format(i, k, t.replace("'", "''")) for i, (k, t) in enumerate(TEMPLATES))
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = r"list_filter(string_split_regex({}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    pairs = "list_distinct(list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1]))"
    return rf"""
WITH t AS (
  SELECT template, license, {pairs.format("w")} AS b
  FROM (SELECT template, license, {words.format(lower.format("body"))} AS w FROM (VALUES
    {values}) AS v(template, license, body))),
s AS (
  SELECT id, doc_id, p, l, {words.format("s")} AS w
  FROM (SELECT id, doc_id, p, l, unnest(string_split_regex(line, '[.!?;][ \t\r]+')) AS s
  FROM (SELECT id, doc_id, p, unnest(string_split(para, chr(10))) AS line, generate_subscripts(string_split(para, chr(10)), 1) AS l
  FROM (SELECT id, doc_id, unnest(ps) AS para, generate_subscripts(ps, 1) AS p
  FROM (SELECT row_number() OVER () AS id, doc_id, string_split_regex({lower.format("coalesce(text, '')")}, '\n[ \t\r]*\n') AS ps FROM documents))))),
ns AS (SELECT *, row_number() OVER () AS k FROM s WHERE len(w) > 0),
u AS (
  SELECT id, 's' || k AS unit, w FROM ns
  UNION ALL
  SELECT id, 'l' || min(k), flatten(list(w ORDER BY k)) FROM ns GROUP BY id, p, l HAVING count(*) > 1
  UNION ALL
  SELECT id, 'p' || min(k), flatten(list(w ORDER BY k)) FROM ns GROUP BY id, p HAVING count(DISTINCT l) > 1),
b AS (SELECT id, unit, {pairs.format("w")} AS b FROM u WHERE len(w) > 1),
m AS (
  SELECT id, unit, license, 2.0::DOUBLE * len(list_intersect(b.b, t.b)) / (len(b.b) + len(t.b)) AS dice
  FROM b JOIN t ON len(b.b) BETWEEN 0.6 * len(t.b) AND 1.6 * len(t.b)),
g AS (
  SELECT id, count(DISTINCT unit) AS n_matches, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, max(dice) AS best_dice
  FROM m WHERE dice >= {THRESHOLD} GROUP BY id),
d AS (SELECT row_number() OVER () AS id, doc_id FROM documents)
SELECT doc_id, coalesce(n_matches, 0)::BIGINT AS n_matches, coalesce(licenses, '') AS licenses, coalesce(best_dice, 0.0)::DOUBLE AS best_dice
FROM d LEFT JOIN g USING (id)
"""


SQL = _sql()
