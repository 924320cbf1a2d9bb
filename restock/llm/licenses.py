"""License scans: Dice coefficient over word bigrams against license templates.

Passages of a text (each line, each paragraph of several lines, and the whole
text if it has several paragraphs) are normalised to lower-case words of
letters and digits, and their sets of word bigrams are compared with those of
every template: Dice = 2 |A and B| / (|A| + |B|). A passage can reach the
threshold t only if its set has at least t / (2 - t) and at most (2 - t) / t
times the template's size, so most templates are pruned by size alone. The
templates are a short list of fixed values and travel inside the plan as
literals; everything happens within a row, nothing is shuffled.

A template with a version or a qualifying word (``TELLING``) does not match a
passage with another one, and of the licenses that match a passage the best stays.

A notice that stands among other words is found by windows over all bigrams of
the text: as many as the template has, starting at those that occur in the
template. The best window of a license that no passage of the text matches is
a match too (passage -1). The SQL twin states the passages and ``TEMPLATES`` only; both agree
where every notice has a passage of its own and none is of a neighbour.

Defined results: null and empty texts, and passages under two words, match
nothing; every passage is judged by itself, so a line and its paragraph may
both match; repeated rows get equal results; an empty table gives an empty
result; other columns pass through or are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DICE = 0.8

# Usual notices of common licenses.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring "
                "rights to this work to the public domain worldwide."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            'associated documentation files (the "Software"), to deal in the Software without restriction, including '
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "All rights reserved."),
]

# Their neighbours, which would pass as one of the above by Dice alone (not in the SQL twin).
_GNU = ("This work is licensed under the GNU {0}General Public License, version {1}.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General "
        "Public License as published by the Free Software Foundation, either version {1} of the License, or (at your "
        "option) any later version.")
_CC = ("This work is licensed under a Creative Commons Attribution-{0} 4.0 International License.",
       "Licensed under CC {1} 4.0.")
SIBLINGS = [*((n, t.format(w, v)) for n, w, v in (("GPL-2.0", "", "2"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"),
                                                  ("AGPL-3.0", "Affero ", "3")) for t in _GNU),
            *((f"CC-{c}-4.0", t.format(w, c)) for c, w in (("BY-SA", "ShareAlike"), ("BY-NC", "NonCommercial"), ("BY-ND", "NoDerivatives"),
                                                           ("BY-NC-SA", "NonCommercial-ShareAlike")) for t in _CC
              if (c, t) != ("BY-NC", _CC[1])), ("CC-BY-4.0", "Licensed under CC BY 4.0.")]
# Word pairs that tell a license from its neighbours: a template that has some of them
# does not match a passage that has others.
TELLING = [*(f"gnu {w}" for w in ("general", "lesser", "affero", "library")), "by nc", "by nd", "by sa", "nc sa", "nc nd",
           *(f"{a} {b}" for a in ("attribution", "noncommercial") for b in ("sharealike", "noncommercial", "noderivatives", "noderivs")),
           *(f"{a} {i}" for a in ("version", "v", "attribution", "sharealike", "noncommercial", "noderivatives", "by", "nc", "sa", "nd")
             for i in range(1, 10)), "1 0", "1 1", "2 0", "2 1", "2 5", "3 0", "4 0"]


def _pairs(passage: str) -> str:
    """SQL for the bigrams (as hashes) of a passage, in order."""
    words = rf"filter(split(lower({passage}), '[^\\p{{L}}\\p{{N}}]+'), w -> w != '')"
    return (f"transform(array({words}), w -> if(size(w) < 2, array(), "
            "transform(sequence(0, size(w) - 2), i -> xxhash64(w[i], w[i + 1]))))[0]")


def _grams(passage: str) -> str:
    """SQL for the distinct bigrams of a passage."""
    return f"array_distinct({_pairs(passage)})"


# of a passage's bigrams b and a template t; 0 if the passage tells of another license
_DICE = ("transform(array(2.0D * size(array_intersect(b, t.grams)) / (size(b) + t.n)), "
         "x -> if(x >= 0.5D and arrays_overlap(b, t.others), 0.0D, x))[0]")


def _literal(templates: DataFrame, dice: float) -> tuple[Column, list[int]]:
    """The templates as one array literal (their number is that of a short list), and their bigrams."""
    rows = (templates.select("license", F.expr(_grams("text")).alias("grams"), F.expr(f"size({_pairs('text')})").alias("m"),
                             F.expr("transform(split('{}', ','), p -> {})".format(",".join(TELLING), _grams("p") + "[0]")).alias("telling"))
            .where(F.size("grams") > 0).collect())
    out = []
    for r in sorted(rows, key=lambda r: (r["license"], len(r["grams"]))):
        n = len(r["grams"])
        others = set(r["telling"]) - set(r["grams"])
        if len(others) == len(set(r["telling"])):
            others = set()
        out.append(F.struct(F.lit(r["license"]).alias("license"), F.lit(n).alias("n"), F.lit(r["m"]).alias("m"),
                            F.lit(dice / (2 - dice) * n - 1e-9).alias("lo"), F.lit((2 - dice) / dice * n + 1e-9).alias("hi"),
                            F.array(*[F.lit(g) for g in r["grams"]]).alias("grams"),
                            F.array(*[F.lit(g) for g in sorted(others)]).cast("array<bigint>").alias("others")))
    return F.array(*out), sorted({g for r in rows for g in r["grams"]})


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, text: str = "text",
         dice: float = DICE, columns: list[str] | None = None) -> DataFrame:
    """(row, passages, hits): every row as a struct, its number of passages, and
    the matches as an array of (passage, license, dice), passage -1 for windows."""
    spark = docs.sparkSession
    known = spark.createDataFrame(templates or TEMPLATES + SIBLINGS, "license string, text string")
    t = f"coalesce(cast(`{text}` as string), '')"
    paragraphs = rf"filter(split({t}, '\n[ \t\r]*(?:\n[ \t\r]*)+'), p -> p != '')"
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns or docs.columns]).alias("row"),
        F.expr(rf"concat(filter(split({t}, '\n'), l -> l != ''), filter({paragraphs}, p -> contains(p, '\n')), "
               f"if(size({paragraphs}) > 1, array({t}), array()))").alias("_p"), F.expr(_pairs(t)).alias("_w"))
    grams = rows.select("row", "_w", F.size("_p").cast("long").alias("passages"),
                        F.expr(f"transform(_p, p -> {_grams('p')})").alias("_g"))
    hits = F.expr(
        "flatten(transform(_g, (b, i) -> transform(filter(_t, t -> size(b) >= t.lo and size(b) <= t.hi), t -> "
        "struct(i as passage, t.license as license, " + _DICE + " as dice))))")
    literal, every = _literal(known, dice)
    # windows: places whose bigram occurs in any template, then those of each template
    windows = F.expr(
        "transform(array(filter(transform(_w, (g, i) -> if(g in ({0}), i, -1)), i -> i >= 0)), at -> if(size(at) = 0, "
        "array(), flatten(transform(_t, t -> transform(filter(at, i -> array_contains(t.grams, _w[i])), i -> "
        "transform(array(array_distinct(slice(_w, i + 1, t.m))), b -> struct(-1 as passage, t.license as license, "
        "{1} as dice))[0])))))[0]".format(
            ", ".join(f"{g}L" if g > -1 << 63 else "cast('-9223372036854775808' as bigint)" for g in every) or "null", _DICE))
    best = F.expr(
        "transform(array_distinct(transform(windows, x -> x.license)), l -> array_max(transform(filter(windows, x -> x.license = l), "
        "x -> struct(x.dice as dice, l as license))))")
    over = lambda c: F.filter(c, lambda h: h["dice"] >= dice)
    return (grams.withColumn("_t", literal).withColumn("hits", over(hits))
            .withColumn("hits", F.expr("filter(hits, h -> not exists(hits, o -> o.passage = h.passage and o.license <> h.license "
                                       "and o.dice > h.dice))"))
            .withColumn("windows", over(windows))
            .withColumn("_b", best).select("row", "passages", F.concat("hits", F.expr(
                "transform(filter(_b, b -> not array_contains(hits.license, b.license)), "
                "b -> struct(-1 as passage, b.license as license, b.dice as dice))")).alias("hits")))


def query(spark, sf_dir: str) -> DataFrame:
    """op8: license notices of every document."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), columns=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), "passages", F.size("hits").cast("long").alias("n_hits"),
                        F.array_join(F.array_sort(F.array_distinct("hits.license")), ",").alias("licenses"),
                        F.round(F.coalesce(F.array_max("hits.dice"), F.lit(0.0)), 6).alias("best"))


_VALUES = ",\n".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(TEMPLATES))
_GRAMS = ("list_distinct(list_transform(range(1, greatest(len({0}), 1)), lambda i: {0}[i] || ' ' || {0}[i + 1]))")
SQL = rf"""
WITH t(k, license, text) AS (VALUES {_VALUES}),
tw AS (SELECT k, license, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM t),
tg AS (SELECT k, license, {_GRAMS.format('w')} AS g FROM tw),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
p AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda l: l <> '')
        || list_filter(regexp_split_to_array(t, '\n[ \t\r]*(?:\n[ \t\r]*)+'), lambda x: contains(x, chr(10)))
        || CASE WHEN len(list_filter(regexp_split_to_array(t, '\n[ \t\r]*(?:\n[ \t\r]*)+'), lambda x: x <> '')) > 1
                THEN [t] ELSE [] END AS ps FROM d),
pw AS (SELECT doc_id, i, regexp_extract_all(lower(x), '[\p{{L}}\p{{N}}]+') AS w
       FROM (SELECT doc_id, unnest(ps) AS x, generate_subscripts(ps, 1) AS i FROM p)),
pg AS (SELECT doc_id, i, {_GRAMS.format('w')} AS g FROM pw),
h AS (SELECT doc_id, i, license, 2.0 * len(list_intersect(pg.g, tg.g)) / (len(pg.g) + len(tg.g)) AS dice
      FROM pg JOIN tg ON len(pg.g) > 0 AND len(list_intersect(pg.g, tg.g)) > 0),
b AS (SELECT doc_id, count(*) AS n_hits, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, max(dice) AS best
      FROM h WHERE dice >= {DICE} GROUP BY doc_id)
SELECT p.doc_id, len(ps)::BIGINT AS passages, coalesce(n_hits, 0)::BIGINT AS n_hits, coalesce(licenses, '') AS licenses,
       round(coalesce(best, 0), 6)::DOUBLE AS best FROM p LEFT JOIN b USING (doc_id)
"""
