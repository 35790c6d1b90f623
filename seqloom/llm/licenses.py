"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

All on DataFrame functions. Words are runs of a-z and 0-9 after lower-casing A-Z. Templates are grouped by length; a
group's windows are twice as long as its longest template and overlap by half, so each occurrence lies in one window
whole. A window shares at least the fraction J of its shingles with a template that it holds, and has as many one-row bands
as make a collision 99.99% likely at 0.8 J. A candidate is a match when 80% of the template's shingles (five words; the
whole template where it is shorter) are in the window.

Before that a screen drops documents that can't match: of each template some words are chosen that more than a fifth of
its shingles hold, so a text without any of them can't hold 80% of the shingles. It loses nothing.

Nulls: a null text has no words. Rows that share a doc_id count as one document. Documents without a match have no row.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower, documents

WORDS, CONTAINED, SURE = 5, 0.8, 0.9999

#: Notices by name. The first sentences of public licences and the short notices in use for them.
TEMPLATES = {
    "mit-notice": "Released under the MIT License",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0",
    "all-rights-reserved": "All rights reserved",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
}


def template_words(text: str) -> list[str]:
    return "".join(c if c in LOWER + "0123456789" else " " for c in text.translate(str.maketrans(UPPER, LOWER))).split()


def shingles_of(words: list[str], k: int) -> list[str]:
    return list(dict.fromkeys(" ".join(words[i : i + k]) for i in range(len(words) - k + 1)))


def screen_words(words: list[str], k: int) -> list[str]:
    """The fewest long words whose shingles are more than a fifth of the template's."""
    all_, found = shingles_of(words, k), []
    for word in sorted(set(words), key=lambda w: (-len(w), w)):
        found.append(word)
        without = sum(not any(w in s.split() for w in found) for s in all_)
        if without / len(all_) < CONTAINED:
            return found
    return found


def groups(templates: dict[str, str]) -> list[tuple[int, int, dict[str, list[str]]]]:
    """(shingle size, window, templates' words) by length; templates of a group differ in length by half at most."""
    out: dict[tuple[int, int], dict[str, list[str]]] = {}
    for name, text in templates.items():
        words = template_words(text)
        if words:
            k = min(WORDS, len(words))
            size = math.ceil(6 * 1.5 ** max(0, math.ceil(math.log(len(words) / 6, 1.5)))) if len(words) > 6 else len(words)
            out.setdefault((k, 2 * size), {})[name] = words
    return [(k, window, found) for (k, window), found in sorted(out.items())]


def bands_for(k: int, window: int, found: dict[str, list[str]]) -> int:
    """One-row bands that make a collision SURE for each of the group's templates where CONTAINED of it is in a window."""
    j = min(math.ceil(CONTAINED * n) / (window - k + 1 + n - math.ceil(CONTAINED * n)) for n in (len(shingles_of(w, k)) for w in found.values()))
    return math.ceil(math.log(1 - SURE) / math.log(1 - j))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, text_col: str = "text") -> DataFrame:
    """doc_id, license, containment (the best window's), first_word (index of its first shingle's first word, the least).

    One pass over the texts: those with a screen word of a length group go on once for each such group. Other columns
    aren't read. Rows that share a doc_id are one document: the best window of any of them counts; a null doc_id is one
    document too. Null and empty texts hold no notice; equal containments tie for the smaller first_word.
    """
    spark = docs.sparkSession
    cases, known = [], []
    for k, window, found in groups(templates):
        n_bands = bands_for(k, window, found)
        must = sorted({w for words in found.values() for w in screen_words(words, k)})
        some = reduce(lambda a, b: a | b, [F.contains("_text", F.lit(w)) for w in must])
        cases.append(F.when(some, F.struct(F.lit(k).alias("k"), F.lit(window).alias("window"), F.lit(n_bands).alias("bands"))))
        known += [(k, window, n_bands, name, shingles_of(w, k)) for name, w in found.items()]
    # band b of some shingles: the least hash with b before it
    band = lambda shingles, n: F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.array_min(F.transform(shingles, lambda s: F.xxhash64(b, s))))
    table = spark.createDataFrame(known, "k int, window int, bands int, license string, _template array<string>")
    table = table.select("k", "window", "license", "_template", F.posexplode(band(F.col("_template"), F.col("bands"))).alias("_band", "_min"))
    rows = docs.select("doc_id", ascii_lower(F.col(text_col)).alias("_text"))
    rows = rows.select("doc_id", "_text", F.explode(F.array_compact(F.array(*cases))).alias("_group")).select("doc_id", "_text", "_group.*")
    words = F.filter(F.split(F.regexp_replace("_text", "[^a-z0-9]+", " "), " "), lambda w: w != "")
    # a window starts at each multiple of half its length that a shingle follows
    size, k = F.size("_words"), F.col("k")
    starts = F.when(size >= k, F.sequence(F.lit(0), size - k, F.expr("window div 2")))
    rows = rows.select("doc_id", "k", "window", "bands", words.alias("_words")).select("*", F.explode(starts).alias("_start"))
    rows = rows.withColumn("_w", F.slice("_words", F.col("_start") + 1, F.col("window"))).drop("_words")
    shingle = F.transform(F.sequence(F.lit(1), F.size("_w") - (k - 1)), lambda i: F.array_join(F.slice("_w", i, k), " "))
    rows = rows.select("doc_id", "k", "window", "bands", "_start", shingle.alias("_shingles"))
    seen = rows.select("doc_id", "k", "window", "_start", "_shingles", F.posexplode(band(F.col("_shingles"), F.col("bands"))).alias("_band", "_min"))
    hits = seen.join(F.broadcast(table), ["k", "window", "_band", "_min"])  # templates and bands are fixed
    both = F.array_intersect("_template", "_shingles")
    share = F.size(both) / F.size("_template")
    first = F.array_min(F.transform(both, lambda s: F.array_position("_shingles", s))) - 1 + F.col("_start")
    hits = hits.select("doc_id", "license", share.alias("containment"), first.alias("first_word")).where(F.col("containment") >= CONTAINED)
    return hits.groupBy("doc_id", "license").agg(F.max("containment").alias("containment"), F.min("first_word").cast("long").alias("first_word"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def _oracle() -> str:
    parts = []
    for k, window, found in groups(TEMPLATES):
        for name, words in found.items():
            shingles = ", ".join(f"'{s}'" for s in shingles_of(words, k))
            parts.append(f"SELECT '{name}' AS license, {k} AS k, {window} AS win, [{shingles}] AS template")
    return f"""
WITH t AS ({' UNION ALL '.join(parts)}),
d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^a-z0-9]+'), lambda w: w <> '') AS w
  FROM documents),
g AS (SELECT DISTINCT k, win FROM t),
s AS (
  SELECT doc_id, w, k, win, unnest(range(0, len(w) - k + 1, win // 2)) AS start FROM d, g WHERE len(w) >= k),
x AS (SELECT doc_id, k, win, start, w[start + 1:start + win] AS v FROM s),
y AS (SELECT doc_id, k, win, start, list_transform(range(1, len(v) - k + 2), lambda i: array_to_string(v[i:i + k - 1], ' ')) AS shingles FROM x WHERE len(v) >= k),
z AS (
  SELECT doc_id, license, start, shingles, template, list_filter(template, lambda s: list_contains(shingles, s)) AS shared
  FROM y JOIN t USING (k, win) WHERE list_has_any(shingles, template)),
m AS (
  SELECT doc_id, license, len(shared) / len(template) AS containment, list_min(list_transform(shared, lambda s: list_position(shingles, s))) - 1 + start AS first_word FROM z)
SELECT doc_id, license, max(containment) AS containment, CAST(min(first_word) AS BIGINT) AS first_word
FROM m WHERE containment >= {CONTAINED} GROUP BY ALL
"""


QUERIES = {"op2_license_scan": op2_license_scan}
ORACLES = {"op2_license_scan": _oracle()}
