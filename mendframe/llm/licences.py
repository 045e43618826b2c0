"""Licence scan: Dice coefficient over word bigrams against licence templates.

A text's units are its lines and its blocks (stretches between blank lines, so a text without one is
a block itself). Unit and template are normalised the same way (lower case, letters a-z and digits
kept, all else one blank) and turned into sets of word bigrams. Dice is twice the shared bigrams over
the sum of both sizes; a template of n bigrams can only reach `least` with units of n least / (2 -
least) to n (2 - least) / least bigrams, so others are not compared. Everything is SQL on one row.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 0.8

#: Common notices by SPDX identifier; the templates of `scan` are a parameter.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This software is released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
]


def bigrams_of(text: str) -> set[str]:
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}


def _literal(text: str) -> str:
    return "'" + text.replace("'", "\\'") + "'"


def units(text: Column) -> Column:
    """Distinct normalised lines and blocks of a text, those without a word left out."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9\n]+", " ")
    blocks = F.transform(F.split(plain, "\n(?: ?\n)+"), lambda b: F.replace(b, F.lit("\n"), F.lit(" ")))
    both = F.transform(F.concat(F.split(plain, "\n"), blocks), lambda u: F.trim(F.regexp_replace(u, " +", " ")))
    return F.array_distinct(F.filter(both, lambda u: u != ""))


def scan(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES, least: float = LEAST
) -> DataFrame:
    """One row per input row: id, n_units, n_matches, licence, score, licences.

    n_matches counts the distinct units that reach `least` with a template; licence and score are the
    best of them (of equal scores the first name), licences all names in order, joined by commas; null
    and empty without a match. Null and empty texts have no unit. Null and repeated ids are rows like
    others; equal texts have equal results; an empty table gives an empty result; other columns are not read.
    """
    listed = sorted((name, sorted(bigrams_of(text))) for name, text in templates)
    smallest = min(len(b) for _, b in listed) * least / (2 - least)
    table = ", ".join(f"named_struct('name', {_literal(name)}, 'n', {len(b)}, 'b', array({', '.join(map(_literal, b))}))" for name, b in listed)
    largest = max(len(b) for _, b in listed) * (2 - least) / least
    # a unit has at least as many bigrams as it has different words, less one: long ones go before theirs are built
    words = f"transform(filter(units, u -> length(u) - length(replace(u, ' ', '')) >= {math.ceil(smallest)}), u -> split(u, ' '))"
    pairs = (
        f"filter(transform(filter({words}, w -> size(array_distinct(w)) <= {math.floor(largest) + 1}), "
        "w -> array_distinct(transform(sequence(1, size(w) - 1), i -> concat(w[i - 1], ' ', w[i])))), b -> size(b) > 0)"
    )
    fits = f"size(u) between t.n * {least}D / {2 - least}D and t.n * {2 - least}D / {least}D"
    scored = (
        f"transform(filter(array({table}), t -> {fits}), "
        "t -> named_struct('score', 2.0D * size(array_intersect(u, t.b)) / (size(u) + t.n), 'name', t.name))"
    )
    rows = df.select(F.col(id_col).alias("id"), units(F.col(text_col)).alias("units"))
    rows = rows.select("id", F.size("units").cast("long").alias("n_units"), F.expr(pairs).alias("pairs"))
    rows = rows.select("id", "n_units", F.expr(f"filter(transform(pairs, u -> filter({scored}, s -> s.score >= {least}D)), m -> size(m) > 0)").alias("hits"))
    best = "array_sort(flatten(hits), (a, b) -> case when a.score > b.score then -1 when a.score < b.score then 1 when a.name < b.name then -1 when a.name > b.name then 1 else 0 end)"
    rows = rows.select("id", "n_units", F.size("hits").cast("long").alias("n_matches"), F.expr(best).alias("best"))
    return rows.select(
        "id",
        "n_units",
        "n_matches",
        F.try_element_at("best", F.lit(1))["name"].alias("licence"),
        F.try_element_at("best", F.lit(1))["score"].alias("score"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("best", lambda s: s["name"]))), ",").alias("licences"),
    )


def oracle(templates: list[tuple[str, str]] = TEMPLATES, least: float = LEAST) -> str:
    """The same scan of documents as SQL of a second engine."""
    values = ", ".join(f"({_quoted(name)}, [{', '.join(_quoted(b) for b in sorted(bigrams_of(text)))}])" for name, text in templates)
    return f"""
WITH templates(name, b) AS (VALUES {values}),
plain AS (SELECT row_number() OVER () AS r, doc_id, regexp_replace(lower(coalesce(text, '')), '[^a-z0-9\\n]+', ' ', 'g') AS p FROM documents),
spread AS (
 SELECT r, unnest(list_concat(string_split(p, chr(10)), string_split_regex(p, '\\n(?: ?\\n)+'))) AS u FROM plain
), units AS (
 SELECT DISTINCT r, trim(regexp_replace(u, '[ \\n]+', ' ', 'g')) AS u FROM spread
), worded AS (
 SELECT r, u, string_split(u, ' ') AS w FROM units WHERE u <> ''
), paired AS (
 SELECT r, u, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM worded
), scored AS (
 SELECT r, u, name, 2.0 * len(list_intersect(paired.b, templates.b)) / (len(paired.b) + len(templates.b)) AS score
 FROM paired JOIN templates ON len(paired.b) BETWEEN len(templates.b) * {least} / {2 - least} AND len(templates.b) * {2 - least} / {least}
), hits AS (SELECT * FROM scored WHERE score >= {least}),
best AS (
 SELECT r, count(DISTINCT u) AS n_matches, max(score) AS score, string_agg(DISTINCT name, ',' ORDER BY name) AS licences FROM hits GROUP BY r
), named AS (SELECT hits.r, min(name) AS licence FROM hits JOIN best ON hits.r = best.r AND hits.score = best.score GROUP BY hits.r),
counted AS (SELECT r, count(*) AS n FROM worded GROUP BY r)
SELECT doc_id, CAST(coalesce(counted.n, 0) AS BIGINT) AS n_units, CAST(coalesce(n_matches, 0) AS BIGINT) AS n_matches, licence,
 round(CAST(score AS DOUBLE), 6) AS score, coalesce(licences, '') AS licences
FROM plain LEFT JOIN best USING (r) LEFT JOIN named USING (r) LEFT JOIN counted USING (r)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"
