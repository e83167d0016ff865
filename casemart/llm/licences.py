"""License scans: normalised lines and texts against licence templates, by Dice over word bigrams.

Built-in functions only, one projection and no shuffle. A text's units are its lines and, if it has
several, the whole text. A unit is normalised (lower case, only a-z, 0-9 and single blanks) and
reduced to its set of word bigrams. A template with b bigrams can reach the Dice coefficient
2 |A and B| / (|A| + |B|) >= t only if t / (2 - t) <= |A| / b <= (2 - t) / t: templates outside
these size bounds are never compared.

Defined cases: a null or empty text has no units; lines of fewer than two words have no bigrams and
match nothing; ties go to the template that comes first by name, then to the earlier unit; repeated
rows give repeated results; an empty table an empty one; columns of other names are ignored.

`notices` also finds what is wrapped over lines or stands inside longer ones: of all runs of words
in a text, across line breaks, whose bigrams number at most those of the upper size bound, the best
one per template. Such a run shares at least t / (2 - t) of the template's bigrams, and the best one
starts and ends with a shared one; so most texts drop out on their set of bigrams, and only
runs between shared bigrams are compared.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

NOTICE = "doc_id long, license string, score double, line long, words long"

# Licence notices and short licence texts: fixed values.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the "
        "License."
    ),
    "bsd-3-clause": "Use of this source code is governed by a BSD-style license that can be found "
    "in the LICENSE file.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International "
    "License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies."
    ),
    "mit": "Released under the MIT License.",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/."
    ),
    "proprietary": "All rights reserved.",
}


def template_bigrams(text: str) -> list[str]:
    """The distinct bigrams of a template, by the same normalisation as a unit's."""
    words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def words_of(unit: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(unit), "[^a-z0-9]+", " ")), " ")


def bigrams(unit: Column) -> Column:
    """The distinct bigrams of a unit, as an array of text."""
    # Bound as an element: inside a lambda every mention of the words would normalise the text again.
    return F.transform(
        F.array(words_of(unit)),
        lambda words: F.array_distinct(
            F.zip_with(
                F.slice(words, 1, F.size(words) - 1),
                F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
                lambda a, b: F.concat(a, F.lit(" "), b),
            )
        ),
    )[0]


def scan(
    docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """Per row: the units, the comparisons that the size bounds left, and all matches.

    matches: array of (license, score, unit), best first; unit is the line from 0, -1 for the whole
    text.
    """
    templates = TEMPLATES if templates is None else templates
    grams = {name: template_bigrams(templates[name]) for name in sorted(templates)}
    grams = {name: g for name, g in grams.items() if g}
    known = F.array(
        *(
            F.struct(
                F.lit(name).alias("name"),
                F.lit(len(g)).alias("size"),
                F.split(F.lit("|".join(g)), r"\|").alias("grams"),
            )
            for name, g in grams.items()
        )
    )
    ratio = threshold / (2 - threshold)
    smallest = min((len(g) for g in grams.values()), default=0)
    lines = F.split(F.col("text"), "\n", -1)
    units = F.when(F.length("text") > 0, F.when(
        F.size(lines) > 1, F.concat(F.array("text"), lines)
    ).otherwise(lines)).otherwise(F.array().cast("array<string>"))
    offset = F.when(F.size("units") > 1, 1).otherwise(0)
    # Each unit with its bigrams; a unit with too few words for the smallest template has none.
    sized = F.transform(
        "units",
        lambda u, i: F.struct(
            (i - offset).alias("unit"),
            F.when(
                F.regexp_count(u, F.lit("[A-Za-z0-9]+")) > smallest * ratio, bigrams(u)
            ).otherwise(F.array().cast("array<string>")).alias("grams"),
        ),
    )
    near = F.transform(
        "sized",
        lambda u: F.filter(
            F.lit(None) if not grams else known,
            lambda t: (F.size(u["grams"]) >= t["size"] * ratio)
            & (F.size(u["grams"]) * ratio <= t["size"])
            & (F.size(u["grams"]) > 0),
        ),
    )
    scored = F.flatten(
        F.zip_with(
            "sized",
            "near",
            lambda u, ts: F.transform(
                ts,
                lambda t: F.struct(
                    t["name"].alias("license"),
                    (
                        2.0
                        * F.size(F.array_intersect(u["grams"], t["grams"]))
                        / (F.size(u["grams"]) + t["size"])
                    ).alias("score"),
                    u["unit"].alias("unit"),
                ),
            ),
        )
    )
    best_first = F.transform(
        F.array_sort(
            F.transform(
                F.filter("scored", lambda m: m["score"] >= threshold),
                lambda m: F.struct((-m["score"]).alias("s"), m["license"], m["unit"]),
            )
        ),
        lambda m: F.struct(
            m["license"].alias("license"), (-m["s"]).alias("score"), m["unit"].alias("unit")
        ),
    )
    return (
        docs.withColumn("units", units)
        .withColumn("sized", sized)
        .withColumn("near", near)
        .withColumn("scored", scored)
        .select(
            "doc_id",
            F.size("units").alias("n_units"),
            F.size("scored").alias("n_compared"),
            best_first.alias("matches"),
        )
    )


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: its best licence, if any, and how much was compared."""
    found = scan(docs.select(F.col("doc_id").cast("long"), "text"))
    best = F.get("matches", F.lit(0))
    return found.select(
        "doc_id",
        F.col("n_units").cast("long").alias("n_units"),
        F.col("n_compared").cast("long").alias("n_compared"),
        F.size("matches").cast("long").alias("n_matches"),
        best["license"].alias("license"),
        best["score"].alias("score"),
        best["unit"].cast("long").alias("unit"),
    )


def notices(
    docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row and template that a run of words reaches: doc_id, license, score, line, words.

    The run is the template's best, then its earliest, then its shortest; line, from 0, is where it
    starts.
    """
    templates = TEMPLATES if templates is None else templates
    grams = {name: template_bigrams(templates[name]) for name in sorted(templates)}
    grams = {name: g for name, g in grams.items() if g}
    if not grams:
        return docs.sparkSession.createDataFrame([], NOTICE)
    ratio = threshold / (2 - threshold)
    known = F.array(
        *(
            F.struct(
                F.lit(name).alias("name"),
                F.lit(len(g)).alias("size"),
                # Shared bigrams that a match has at least, and bigrams that a run has at most.
                F.lit(max(1, math.ceil(len(g) * ratio - 1e-9))).alias("least"),
                F.lit(math.floor(len(g) / ratio + 1e-9)).alias("most"),
                F.split(F.lit("|".join(g)), r"\|").alias("grams"),
            )
            for name, g in grams.items()
        )
    )
    every = F.split(F.lit("|".join(sorted({x for g in grams.values() for x in g}))), r"\|")
    # The shared bigrams are read twice, so that they are found once per text.
    asked = docs.select(
        "doc_id", "text", F.array_intersect(bigrams(F.col("text")), every).alias("shared")
    ).select(
        "doc_id",
        "text",
        F.explode(
            F.when(
                F.size("shared") > 0,
                F.filter(
                    known,
                    lambda t: F.size(F.array_intersect(t["grams"], F.col("shared"))) >= t["least"],
                ),
            )
        ).alias("t"),
    )
    placed = asked.select(
        "doc_id",
        "t",
        F.flatten(
            F.transform(
                F.split("text", "\n", -1),
                lambda line, i: F.transform(
                    F.filter(words_of(line), lambda w: w != ""),
                    lambda w: F.struct(i.alias("line"), w.alias("word")),
                ),
            )
        ).alias("words"),
    )
    paired = placed.select(
        "doc_id",
        "t",
        F.transform("words", lambda w: w["line"]).alias("lines"),
        F.zip_with(
            F.slice("words", 1, F.size("words") - 1),
            F.slice("words", 2, F.size("words") - 1),
            lambda a, b: F.concat(a["word"], F.lit(" "), b["word"]),
        ).alias("grams"),
    )
    # Places of the shared bigrams.
    hit = paired.withColumn(
        "hits",
        F.filter(
            F.transform(
                "grams", lambda g, k: F.when(F.array_contains(F.col("t.grams"), g), k)
            ),
            lambda k: k.isNotNull(),
        ),
    )

    def run(start: Column, end: Column) -> Column:
        """(-score, start, end) of the run between two places; its bigrams are made once."""
        own = F.array_distinct(F.slice("grams", start + 1, end - start + 1))
        return F.transform(
            F.array(own),
            lambda g: F.struct(
                (
                    -2.0
                    * F.size(F.array_intersect(g, F.col("t.grams")))
                    / (F.size(g) + F.col("t.size"))
                ).alias("s"),
                start.alias("start"),
                end.alias("end"),
            ),
        )[0]

    least, most = F.col("t.least"), F.col("t.most")
    # A start's ends: at least `least` shared bigrams and at most `most` bigrams further on.
    runs = F.transform(
        "hits",
        lambda start, i: F.transform(
            F.filter(
                F.slice("hits", i + least, most - least + 1), lambda end: end - start < most
            ),
            lambda end: run(start, end),
        ),
    )
    best = hit.select("doc_id", "t", "lines", F.array_min(F.flatten(runs)).alias("best"))
    return best.filter(-F.col("best.s") >= threshold).select(
        "doc_id",
        F.col("t.name").alias("license"),
        (-F.col("best.s")).alias("score"),
        F.get("lines", F.col("best.start")).cast("long").alias("line"),
        (F.col("best.end") - F.col("best.start") + 2).cast("long").alias("words"),
    )


def notice_digest(docs: DataFrame) -> DataFrame:
    return notices(docs.select(F.col("doc_id").cast("long"), "text"))


def oracle() -> str:
    """`digest` in DuckDB SQL, from the templates' own texts."""
    quoted = ", ".join(
        "('{}', '{}')".format(n, t.replace("'", "''")) for n, t in sorted(TEMPLATES.items())
    )
    words = "string_split(trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g')), ' ')"
    grams = (
        "list_distinct(list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1]))"
    )
    ratio = THRESHOLD / (2 - THRESHOLD)
    return f"""
    WITH templates AS (
      SELECT name, {grams.format(w='w')} AS g
      FROM (SELECT name, {words.format('body')} AS w FROM (VALUES {quoted}) t(name, body))),
    parts AS (
      SELECT row_number() OVER () AS row_id, doc_id, text,
             CASE WHEN text IS NULL OR text = '' THEN []
                  WHEN contains(text, chr(10)) THEN list_concat([text], string_split(text, chr(10)))
                  ELSE [text] END AS units
      FROM documents),
    units AS (
      SELECT row_id, unnest(range(1, len(units) + 1)) - CASE WHEN len(units) > 1 THEN 2 ELSE 1 END
               AS unit, unnest(units) AS body
      FROM parts),
    sized AS (
      SELECT row_id, unit, {grams.format(w='w')} AS g
      FROM (SELECT row_id, unit, {words.format('body')} AS w FROM units)),
    compared AS (
      SELECT s.row_id, s.unit, t.name,
             2.0::DOUBLE * len(list_intersect(s.g, t.g)) / (len(s.g) + len(t.g)) AS score
      FROM sized s JOIN templates t
        ON len(s.g) > 0 AND len(s.g) >= len(t.g) * {ratio!r}::DOUBLE
       AND len(s.g) * {ratio!r}::DOUBLE <= len(t.g)),
    best AS (
      SELECT row_id, count(*) AS n_compared,
             count(*) FILTER (score >= {THRESHOLD}::DOUBLE) AS n_matches,
             first(struct_pack(l := name, s := score, u := unit) ORDER BY score DESC, name, unit)
               FILTER (score >= {THRESHOLD}::DOUBLE) AS b
      FROM compared GROUP BY row_id)
    SELECT p.doc_id, len(p.units)::BIGINT AS n_units, coalesce(n_compared, 0)::BIGINT AS n_compared,
           coalesce(n_matches, 0)::BIGINT AS n_matches, b.l AS license, b.s AS score,
           b.u::BIGINT AS unit
    FROM parts p LEFT JOIN best USING (row_id)"""
