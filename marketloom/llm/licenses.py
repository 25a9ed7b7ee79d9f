"""Operator 1: find license notices, with DataFrame functions only.

Texts and templates are words of letters and digits in lower case, and shingles of five words. For a
template of m shingles a text is read in overlapping windows of a little over 2 m shingles, m apart, so
that one of them holds any notice of up to 1.25 m shingles whole. Windows and templates meet where a
MinHash band agrees; the number of bands follows from the least similarity that such a window has
and the wanted probability. What meets is checked by the exact share of the template's shingles that
the window holds.

A window without any of a template's shingles cannot share a minimum with it. So signatures are taken
only of windows around known shingles; this changes no result. The templates are broadcast; their
number of shingles is checked against ``MOST_SHINGLES``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import pick
from marketloom.session import stored

#: Words of a shingle; share of a template's shingles that must be found.
SHINGLE, CONTAINMENT = 5, 0.8
#: Chance that a window with just that share meets its template.
PROBABILITY = 0.9999
#: Shingles of all templates together; the bound of what is broadcast.
MOST_SHINGLES = 20_000

#: Public license notices.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 notice": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met",
    "CC-BY": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "GPL notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                  "Public License as published by the Free Software Foundation",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MIT": "Released under the MIT License",
    "MIT notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}
WORDS = r"[\p{L}\p{N}]+"


def window_length(m: int) -> int:
    """Shingles of a window for templates of m shingles."""
    return 2 * m + math.ceil(m / 4)


def bands(containment: float = CONTAINMENT, probability: float = PROBABILITY, rows: int = 1) -> int:
    """Bands of ``rows`` minima that make a window with this share of a template meet it with the given
    probability. Such a window has at least containment * m shingles in common of at most
    (2.25 + 1 - containment) m + 1 in either."""
    similarity = containment / (3.25 + 1 - containment)  # window_length(m) <= 3.25 m, reached at m = 1
    return math.ceil(math.log(1 - probability) / math.log(1 - similarity ** rows))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0))


def shingle_hashes(hashes: Column) -> Column:
    """One hash for each place where five words start (and shorter ones at the end, which match nothing)."""
    return F.transform(hashes, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, SHINGLE)]))


def shingle_texts(words: Column) -> Column:
    """The different shingles of a list of words, written out."""
    return F.array_distinct(F.when(F.size(words) >= SHINGLE, F.transform(
        F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1)), lambda i: F.array_join(F.slice(words, i, SHINGLE), " ")))
        .otherwise(F.array().cast("array<string>")))


def signature(shingles: Column, count: int) -> Column:
    """The least hash of a window's shingles under each of ``count`` hash functions."""
    def least(k: int) -> Column:
        return F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(k))))

    return F.array(*[least(k) for k in range(count)])


def _templates(spark: SparkSession, templates: Mapping[str, str], count: int) -> DataFrame:
    """license, m, own (its shingles' hashes), texts, minima."""
    listed = F.array(*[F.struct(F.lit(k).alias("license"), F.lit(v).alias("text")) for k, v in sorted(templates.items())])
    rows = (spark.range(1).select(F.explode(listed).alias("t"))
            .select("t.license", words_of(F.col("t.text")).alias("words"))
            .select("license", "words", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
            .select("license", "words", F.slice(shingle_hashes(F.col("hashes")), F.lit(1),
                                                F.greatest(F.size("words") - (SHINGLE - 1), F.lit(0))).alias("own")))
    return rows.select("license", F.size("own").alias("m"), "own", shingle_texts(F.col("words")).alias("texts"),
                       signature(F.col("own"), count).alias("minima"))


def scan(docs: DataFrame, templates: Mapping[str, str] | None = None, *, containment: float = CONTAINMENT,
         probability: float = PROBABILITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, license, ``containment`` (the largest share of the template's shingles in one window) and
    ``first_word`` (where the first of its shingles in an accepted window starts, from 0).

    One row for each row of ``docs`` and license found in it; repeated rows and NULL ids are rows of their own.
    NULL and empty texts hold nothing. Templates need at least five words.
    """
    spark, count = docs.sparkSession, bands(containment, probability)
    known = stored(_templates(spark, TEMPLATES if templates is None else templates, count), "templates")
    listed = known.select("license", "m", "own").collect()
    if any(t.m < 1 for t in listed) or sum(t.m for t in listed) > MOST_SHINGLES:
        raise ValueError(f"templates need {SHINGLE} words each and at most {MOST_SHINGLES} shingles together")
    sizes: dict[int, set[int]] = {}
    for t in listed:
        for h in t.own:
            sizes.setdefault(h, set()).add(t.m)
    every = list(sizes)
    size_of = F.map_from_arrays(F.array(*[F.lit(h).cast("bigint") for h in every]),
                                F.array(*[F.array(*[F.lit(m) for m in sorted(sizes[h])]) for h in every]))

    rows = pick(docs, doc_id=id_col, text=text_col)
    hashed = (rows.select("doc_id", words_of(F.col("text")).alias("words"))
              .select("doc_id", "words", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
              # The row's number also keeps the filter below from being merged into this step, which would hash twice.
              .select("doc_id", "words", shingle_hashes(F.col("hashes")).alias("shingles"),
                      F.monotonically_increasing_id().alias("row")))
    held = hashed.where(F.exists("shingles", lambda h: h.isin(every)))
    hits = F.filter(F.transform("shingles", lambda h, i: F.struct(h.alias("h"), i.alias("at"))), lambda s: s["h"].isin(every))

    def around(s: Column) -> Column:
        """Windows (m, number) that hold this place, for each size of template that has the shingle."""
        return F.flatten(F.transform(F.element_at(size_of, s["h"]), lambda m: F.transform(
            F.sequence(F.greatest(F.floor(s["at"] / m) - 2, F.lit(0)), F.floor(s["at"] / m)),
            lambda j: F.struct(m.alias("m"), j.alias("j")))))

    windows = (held.withColumn("hits", hits)
               .withColumn("w", F.explode(F.array_distinct(F.flatten(F.transform("hits", around)))))
               .select("row", "doc_id", "words", "shingles", "w.m", (F.col("w.j") * F.col("w.m")).cast("int").alias("start"))
               .withColumn("long", (2 * F.col("m") + F.ceil(F.col("m") / 4)).cast("int"))
               .select("row", "doc_id", "m", "start", F.slice("shingles", F.col("start") + 1, F.col("long")).alias("shingles"),
                       F.slice("words", F.col("start") + 1, F.col("long") + SHINGLE - 1).alias("words")))
    minima = windows.select("row", "doc_id", "m", "start", "words", F.posexplode(signature(F.col("shingles"), count))
                            .alias("band", "least"))
    wanted = known.select("license", F.col("m").alias("own_m"), "texts", F.posexplode("minima").alias("own_band", "own_least"))
    met = (minima.join(F.broadcast(wanted), (F.col("m") == F.col("own_m")) & (F.col("band") == F.col("own_band"))
                       & (F.col("least") == F.col("own_least")))
           .groupBy("row", "doc_id", "start", "license").agg(F.first("words").alias("words"), F.first("texts").alias("texts")))
    held_texts = shingle_texts(F.col("words"))
    found = met.withColumn("held", held_texts).withColumn("both", F.array_intersect("held", "texts"))
    # Places of the window's words where a shingle of the template starts.
    first = F.array_min(F.filter(F.transform("words", lambda w, i: F.when(
        F.array_contains(F.col("both"), F.array_join(F.slice(F.col("words"), i + 1, SHINGLE), " ")), i)), lambda i: i.isNotNull()))
    return (found.withColumn("containment", F.size("both") / F.size("texts")).where(F.col("containment") >= containment)
            .withColumn("first", F.col("start") + first)
            .groupBy("row", "doc_id", "license").agg(F.max("containment").alias("containment"), F.min("first").alias("first"))
            .select("doc_id", "license", "containment", F.col("first").cast("bigint").alias("first_word")))


def scan_sql(templates: Mapping[str, str] | None = None, containment: float = CONTAINMENT) -> str:
    """The exact answer in SQL: every window around every shared shingle, without MinHash."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in sorted((templates or TEMPLATES).items()))
    grams = f"list_transform(generate_series(1, len(w) - {SHINGLE - 1}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' '))"
    return f"""
WITH templates(license, text) AS (VALUES {values}),
split AS (SELECT license, regexp_extract_all(lower(text), '{WORDS}') AS w FROM templates),
known AS (SELECT license, len(w) - {SHINGLE - 1} AS m, len(list_distinct({grams})) AS n, unnest(list_distinct({grams})) AS s FROM split),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(text), '{WORDS}') AS w FROM documents),
places AS (SELECT r, doc_id, unnest(generate_series(1, len(w) - {SHINGLE - 1})) - 1 AS p, unnest({grams}) AS s FROM docs
           WHERE len(w) >= {SHINGLE}),
hits AS (SELECT * FROM places JOIN known USING (s)),
windows AS (SELECT *, unnest(generate_series(greatest(p // m - 2, 0), p // m)) AS j FROM hits),
held AS (SELECT r, doc_id, license, j, COUNT(DISTINCT s) / MAX(n)::DOUBLE AS c, MIN(p) AS first FROM windows
         WHERE p < j * m + 2 * m + ceil(m / 4) GROUP BY ALL)
SELECT doc_id, license, MAX(c) AS containment, MIN(first)::BIGINT AS first_word FROM held WHERE c >= {containment}
GROUP BY r, doc_id, license"""
