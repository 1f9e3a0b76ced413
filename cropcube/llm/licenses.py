"""License scans in DataFrame functions alone.

Licence templates fall into classes by their number of word shingles, rounded up to
a power of two.  A text is read in overlapping windows somewhat larger than the
class.  Windows and templates have MinHash signatures; one equal value in any band
retrieves the template, and the exact share of the template's shingles that the
window holds verifies it.

Band settings: one row a band, 48 bands.  A template has more than half of its
class's shingles c, and a window holds at most c + ceil(c/4), so a window with 0.8 of a
template has a Jaccard similarity above 0.4c / (1.25c + 0.1c + 1) >= 0.27 for c >= 8, and
0.3 or more below (checked for each c in the tests).  It escapes 48 bands with a
probability under 0.73^48, or 3 in ten million; windows overlap, which lowers it further.

A band can only collide if the window holds the template's smallest shingle of that
band, so windows are formed around those shingles alone.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropcube.llm.license_texts import TEXTS

SHINGLE, CONTAINMENT, BANDS = 5, 0.8, 48

def _header(name: str, version: str, mark: str = ":", comma: str = ",") -> str:
    return (f"This program is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {name} "
            f"as published by the Free Software Foundation{comma} either version {version} of the License, or (at your "
            "option) any later version.")


_GPL, _LGPL, _AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"
_CC = {"by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nc": "Attribution-NonCommercial",
       "by-nc-sa": "Attribution-NonCommercial-ShareAlike", "by-nd": "Attribution-NoDerivatives",
       "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}

# Whole texts, the standard headers, the openings that relatives share, and
# notices by which texts state their licence.
TEMPLATES = TEXTS + [
    ("mit-notice", "Released under the MIT License."),
    ("mit-family-opening",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
     "copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-header",
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at"),
    *[(f"{i}-{v}-notice", f"This work is licensed under the GNU {n}, version {v.removesuffix('.0')}.")
      for i, n, v in (("gpl", _GPL, "2.0"), ("gpl", _GPL, "3.0"), ("lgpl", _LGPL, "2.1"), ("lgpl", _LGPL, "3.0"),
                      ("agpl", _AGPL, "3.0"))],
    ("gpl-2.0-or-later-header", _header(_GPL, "2", ";", ";")),
    ("gpl-3.0-or-later-header", _header(_GPL, "3")),
    ("lgpl-2.1-or-later-header",
     _header(_LGPL, "2.1", ";", ";").replace("This program", "This library")),
    ("lgpl-3.0-or-later-header", _header(_LGPL, "3")),
    ("agpl-3.0-or-later-header", _header(_AGPL, "3")),
    ("agpl-3.0-section-13",  # what sets the whole text apart from that of gpl-3.0
     "Notwithstanding any other provision of this License, if you modify the Program, your modified version must "
     "prominently offer all users interacting with it remotely through a computer network (if your version supports "
     "such interaction) an opportunity to receive the Corresponding Source of your version by providing access to the "
     "Corresponding Source from a network server at no charge, through some standard or customary means of "
     "facilitating copying of software."),
    *[(f"cc-{k}-4.0-notice", f"Licensed under CC {k.upper()} 4.0.") for k in _CC],
    *[(f"cc-{k}-4.0", f"This work is licensed under a Creative Commons {n} 4.0 International License.")
      for k, n in _CC.items()],
    ("bsd-family-opening",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met"),
    ("mpl-2.0-header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc-family-opening",
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted"),
    ("unlicense-opening", "This is free and unencumbered software released into the public domain."),
]


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row (a lambda would evaluate it at each use)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingles(text: Column) -> Column:
    """Hashes of the runs of five words at each word; words are a-z and 0-9, A-Z lower-cased.

    A text of one to four words has one shingle, all of it; one without words has none.
    """
    plain = F.trim(F.regexp_replace(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), "[^a-z0-9]+", " "))

    def of(words: Column) -> Column:
        last = F.size(words) - SHINGLE
        runs = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                           lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))
        return F.when(F.get(words, F.lit(0)) == "", F.array().cast("array<bigint>")).otherwise(runs)

    return let(F.split(plain, " "), of)


def signature(found: Column) -> Column:
    """MinHash of an array of shingle hashes: the smallest value for each of 48 seeds."""
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)),
                       lambda i: F.array_min(F.transform(found, lambda x: F.xxhash64(x, i))))


def window_size(c: int) -> tuple[int, int]:
    """Shingles in a window of the class, and the step between windows."""
    step = -(-c // 4)
    return c + step, step


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """license, c (class), own (distinct shingles) and sig of each template; those without words go."""
    rows = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("license"), F.lit(b).alias("text")) for a, b in templates])))
    own = rows.select("license", F.array_distinct(shingles(F.col("text"))).alias("own")).where(F.size("own") > 0)
    c = F.pow(F.lit(2), F.ceil(F.log2(F.size("own")) - 1e-9)).cast("int")
    return own.select("license", c.alias("c"), "own", signature(F.col("own")).alias("sig"))


def scan(docs: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, license, containment (largest over windows) and first_word for each licence found.

    ``first_word`` is where the first window with that containment starts, counted in
    words.  Near relatives are reported too, each with its own containment: the text of
    one has 1.0 of that one and less of the others.  A null, empty or wordless text has no licence; rows that repeat a doc_id are
    scanned each and share one result row for each licence; a null doc_id is kept as one.
    Other columns are not read; an empty table gives an empty result.  The driver reads
    only the templates' signatures, whose number the template list bounds.
    """
    spark = docs.sparkSession
    known = template_table(spark, templates)
    keys: dict[int, list[int]] = {}
    for row in _smallest(known).collect():  # 48 for each template at most
        keys.setdefault(row.c, []).append(row.x)

    def windows(found: Column) -> Column:
        """Windows of all classes around the shingles that can collide, as structs."""
        out = []
        for c, own in sorted(keys.items()):
            size, step = window_size(c)
            places = F.filter(F.transform(found, lambda x, i: F.when(x.isin(own), i)), lambda i: i.isNotNull())
            near = F.flatten(F.transform(places, lambda p: F.sequence(
                F.greatest(F.floor((p - size) / step) + 1, F.lit(0)), F.floor(p / step))))
            out.append(F.transform(F.array_distinct(near), lambda n: F.struct(
                F.lit(c).alias("c"), (n * step).cast("int").alias("first_word"),
                F.slice(found, (n * step + 1).cast("int"), F.lit(size)).alias("has"))))
        return F.concat(*out)

    met = docs.select("doc_id", F.inline(let(shingles(F.col("text").cast("string")), windows)))
    bands = met.select("doc_id", "c", "first_word", "has", F.posexplode(signature(F.col("has"))).alias("band", "value"))
    wanted = known.select("c", "license", F.posexplode("sig").alias("band", "value"))
    whole = known.select("license", "own")  # once a template, not once a band
    share = F.size(F.array_intersect("has", "own")) / F.size("own")
    found = bands.join(F.broadcast(wanted), ["c", "band", "value"]).join(F.broadcast(whole), "license") \
        .select("doc_id", "license", "first_word", share.alias("containment")).where(F.col("containment") >= containment)
    return found.groupBy("doc_id", "license").agg(
        F.max("containment").alias("containment"), F.max_by("first_word", F.struct("containment", -F.col("first_word")))
        .alias("first_word"))


def _smallest(known: DataFrame) -> DataFrame:
    """c and x: for each class, the shingles that are smallest in some band of some template."""
    each = known.select("c", "license", F.explode("own").alias("x"), "sig")
    hit = F.exists(F.sequence(F.lit(1), F.lit(BANDS)), lambda i: F.get("sig", i - 1) == F.xxhash64("x", i))
    return each.where(hit).select("c", "x").distinct()


def oracle(templates=TEMPLATES, containment: float = CONTAINMENT) -> str:
    """DuckDB SQL of :func:`scan` by exact containment over the same windows, without MinHash."""
    values = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in templates)
    plain = ("trim(regexp_replace(translate({}, '" + string.ascii_uppercase + "', '" + string.ascii_lowercase
             + "'), '[^a-z0-9]+', ' ', 'g'))")
    cut = f"""CASE WHEN w = [''] THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(len(w) - {SHINGLE - 1}), lambda i: array_to_string(w[i + 1:i + {SHINGLE}], ' ')) END"""
    return f"""
WITH templates(license, body) AS (VALUES {values}),
t AS (SELECT license, list_distinct({cut}) AS own FROM (
    SELECT license, string_split({plain.format('body')}, ' ') AS w FROM templates)),
t2 AS (SELECT license, len(own) AS n, CAST(pow(2, ceil(log2(len(own)) - 1e-9)) AS INT) AS c, unnest(own) AS s
    FROM t WHERE len(own) > 0),
t3 AS (SELECT *, CAST(ceil(c / 4.0) AS INT) AS step FROM t2),
d AS (SELECT doc_id, {cut} AS s FROM (
    SELECT doc_id, string_split({plain.format('text')}, ' ') AS w FROM documents WHERE text IS NOT NULL)),
places AS (SELECT doc_id, unnest(s) AS s, unnest(range(len(s))) AS p FROM d),
hits AS (SELECT doc_id, license, n, step, s,
        unnest(range(CAST(greatest(floor((p - c - step) / step::DOUBLE) + 1, 0) AS BIGINT), CAST(floor(p / step::DOUBLE) AS BIGINT) + 1))
        * step AS first_word
    FROM places JOIN t3 USING (s)),
shares AS (SELECT doc_id, license, first_word, count(DISTINCT s) / n::DOUBLE AS containment
    FROM hits GROUP BY doc_id, license, first_word, n)
SELECT doc_id, license, max(containment) AS containment,
    CAST(arg_max(first_word, containment * 1e9 - first_word / 1e3) AS INT) AS first_word
FROM shares WHERE containment >= {containment} GROUP BY doc_id, license"""
