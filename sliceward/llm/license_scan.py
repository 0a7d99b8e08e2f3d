"""License scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies them.

Texts and templates are lower-cased runs of letters and digits. A window is a few neighbouring five-word shingles, and
windows overlap by half. A window's MinHash values are minima of the shingles' hashes under fixed exclusive-or masks;
each value is a band of its own, as one shared shingle must suffice for the short license lines. If a template has one
shingle (five words), that shingle is the minimum of one of its two windows with probability 1/3 in each band, so all
bands miss it with probability (2/3) ** bands: 0.15 % for 16. Longer templates have more windows and are missed far
less often. Retrieved pairs of document and template are then checked by the exact share of the template's shingles.

All expressions are built in; windows meet the bands of the templates in a broadcast join, so texts are shuffled only
for the documents' verification. Templates are a parameter whose bands are counted before they are broadcast.
"""

from __future__ import annotations

import random
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sliceward.sources.stored import settle

#: Words of a shingle, shingles of a window, step between windows, number of bands.
SHINGLE, WINDOW, STEP, BANDS = 5, 4, 2, 16
#: Share of a template's shingles that a document must hold.
CONTAINED = 0.8
#: Bands of all templates that may be broadcast; 16 bytes each.
MOST_BANDS = 1_000_000
NOT_WORD = r"[^\p{L}\p{N}]+"

#: Usual notices of public licenses. Shorter ones than five words cannot be told from prose.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files, to deal in the Software without restriction",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of "
    "the License at",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def words() -> Column:
    """Words of the column text; an empty text has none."""
    found = F.split(F.lower(F.coalesce("text", F.lit(""))), NOT_WORD)
    return F.filter(found, lambda w: w != "")


def masks(bands: int) -> list[int]:
    rng = random.Random(1)
    return [rng.getrandbits(63) for _ in range(bands)]


def bands_of(rows: DataFrame, bands: int = BANDS) -> DataFrame:
    """key, at, band: the MinHash values of every window of rows with key and words; at: first word of the window."""
    last = F.greatest(F.size("words") - F.lit(SHINGLE), F.lit(0))
    at = rows.filter(F.size("words") >= SHINGLE).select("key", "words", F.explode(F.sequence(F.lit(0), last, F.lit(STEP))).alias("at"))

    def shingle(k: int) -> Column:
        parts = [F.get("words", F.col("at") + (k + i)) for i in range(SHINGLE)]
        return F.when(F.col("at") + (k + SHINGLE) <= F.size("words"), F.xxhash64(*parts))

    hashed = at.select("key", "at", *[shingle(k).alias(f"h{k}") for k in range(WINDOW)])
    # Minima are taken back through their mask, so that a band's value is the hash of its smallest shingle.
    least = [F.least(*[F.col(f"h{k}").bitwiseXOR(F.lit(m)) for k in range(WINDOW)]).bitwiseXOR(F.lit(m)) for m in masks(bands)]
    return hashed.select("key", "at", F.explode(F.array(*least)).alias("band"))


def template_rows(spark: SparkSession, templates: Mapping[str, str]) -> DataFrame:
    pairs = F.create_map(*[F.lit(x) for pair in templates.items() for x in pair])
    rows = spark.range(1).select(F.explode(pairs).alias("key", "text"))
    return rows.select("key", words().alias("words"))


def shingles() -> Column:
    """Distinct shingles of the column words."""
    starts = F.sequence(F.lit(0), F.size("words") - F.lit(SHINGLE))
    made = F.transform(starts, lambda i: F.concat_ws(" ", F.slice("words", i + 1, F.lit(SHINGLE))))
    return F.when(F.size("words") >= SHINGLE, F.array_distinct(made)).otherwise(F.array().cast("array<string>"))


def scan(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, bands: int = BANDS, contained: float = CONTAINED
) -> DataFrame:
    """doc_id, license, containment (share of the template's distinct shingles in the document) and at (first word).

    One row for each document and template with a containment of at least ``contained``. Null, empty and short texts
    match nothing. Rows with the same doc_id (null is one id) are one document: the best of them counts.
    """
    spark = docs.sparkSession
    known = template_rows(spark, templates)
    short = known.filter(F.size("words") < SHINGLE).count()
    if short:
        raise ValueError(f"{short} templates have fewer than {SHINGLE} words")
    # A window of a document may begin and end anywhere in a template, so any of its shingles can be the minimum.
    single = known.select("key", "words", F.explode(F.sequence(F.lit(0), F.size("words") - F.lit(SHINGLE))).alias("at"))
    parts = [F.get("words", F.col("at") + i) for i in range(SHINGLE)]
    index = settle(single.select(F.col("key").alias("license"), F.xxhash64(*parts).alias("band")).distinct(), "license_bands")
    if index.count() > MOST_BANDS:
        raise ValueError(f"more than {MOST_BANDS} bands of templates cannot be broadcast")
    rows = docs.select(F.col("doc_id").alias("key"), "text").select("key", words().alias("words"))
    hits = bands_of(rows, bands).join(F.broadcast(index), "band")
    found = settle(hits.groupBy("key", "license").agg(F.min("at").alias("at")), "license_hits")
    wanted = found.groupBy("key").agg(F.collect_list(F.struct("license", "at")).alias("hits"))
    texts = docs.select(F.col("doc_id").alias("k"), "text")
    beside = texts.join(wanted, F.col("k").eqNullSafe(F.col("key"))).select("key", "hits", words().alias("words"))
    own = beside.select("key", "hits", shingles().alias("own"))
    whole = known.select(F.col("key").alias("license"), shingles().alias("whole"))
    pairs = own.select("key", "own", F.explode("hits").alias("hit")).select("key", "own", "hit.license", "hit.at")
    share = F.size(F.array_intersect("whole", "own")) / F.size("whole")
    checked = pairs.join(F.broadcast(whole), "license").withColumn("containment", share)
    best = checked.filter(F.col("containment") >= contained).groupBy("key", "license")
    return best.agg(F.max("containment").alias("containment"), F.min("at").alias("at")).withColumnRenamed("key", "doc_id")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "license", "containment")


_TEMPLATE_ROWS = ", ".join(f"('{k}', '{v}')" for k, v in TEMPLATES.items())
_WORDS = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS words"
#: The same without retrieval: every template against every document that holds one of its shingles.
OP1_SQL = f"""
WITH d AS (SELECT *, {_WORDS} FROM documents),
t AS (SELECT *, {_WORDS} FROM (VALUES {_TEMPLATE_ROWS}) v(license, text)),
ds AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS s
       FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM d)),
ts AS (SELECT DISTINCT license, array_to_string(words[i:i + 4], ' ') AS s
       FROM (SELECT license, words, unnest(range(1, len(words) - 3)) AS i FROM t)),
n AS (SELECT license, count(*) AS n FROM ts GROUP BY license)
SELECT doc_id, license, count(*) / any_value(n)::DOUBLE AS containment
FROM ds JOIN ts USING (s) JOIN n USING (license) GROUP BY doc_id, license
HAVING count(*) / any_value(n)::DOUBLE >= {CONTAINED}
"""
