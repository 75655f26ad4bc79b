"""License scans: MinHash bands over overlapping windows of words find templates, shingles verify them.

A template of n words is looked for in windows of n + n // 4 words that start every
n // 4 words, so any run of n words lies whole in some window.  A window and a template
collide when one of their bands is equal; the number of bands is set so that a pair with
the least similarity that can pass is missed with probability ``MISS`` at most.  Of the
pairs found, the share of the template's shingles of five words that the window holds
is worked out exactly; from ``SHARE`` on it is a match.

All in Spark's own functions.  Only windows with a key word of a template of their length
are made: it stands in more than 1 - ``SHARE`` of the template's shingles, so a window
(and a text) without it cannot match.

Defined results: null and empty texts match nothing; templates of fewer than five words
are refused.  One row for each document row and license, at the window with the largest
share, of equal ones the first; a place where another license's share is larger does not
count for the lesser one.  Repeated documents give a row each.  Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.llm.native import let, upto

SHINGLE = 5
SHARE = 0.8
MISS = 1e-4

# Public notices as they are commonly worded, with their SPDX names.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def shingles(w: Column) -> Column:
    """64-bit hashes of all runs of five words, in order."""
    return upto(F.size(w) - SHINGLE, lambda i: F.xxhash64(F.array_join(F.slice(w, i + 1, F.lit(SHINGLE)), " ")))


def stride(n: int) -> int:
    return max(1, n // 4)


def bands(n: int, share: float, miss: float) -> int:
    """Bands of one minimum each, so that a window that just passes is missed with ``miss`` at most."""
    template, window = n - SHINGLE + 1, n + stride(n) - SHINGLE + 1
    least = share * template / (window + (1 - share) * template)
    return math.ceil(math.log(miss) / math.log(1 - least))


def minima(hashes: Column, n_bands: int) -> Column:
    """A minimum for each band: of hashes met with a mask, the least is a random one of the set."""
    masks = F.transform(F.sequence(F.lit(1), F.lit(n_bands)), lambda j: F.xxhash64(j))
    return let(F.struct(masks.alias("m"), hashes.alias("h")), lambda v: F.transform(
        v["m"], lambda m: F.array_min(F.transform(v["h"], lambda h: h.bitwiseXOR(m)))
    ))


def key_word(template: Sequence[str], share: float) -> str:
    """The longest word in more than 1 - ``share`` of the template's distinct shingles."""
    runs = {tuple(template[i : i + SHINGLE]) for i in range(len(template) - SHINGLE + 1)}
    fit = [w for w in set(template) if sum(w in r for r in runs) > (1 - share) * len(runs) + 1e-9]
    if not fit:
        raise ValueError(f"no word stands in enough shingles of {' '.join(template)!r}; cut it in shorter templates")
    return max(fit, key=lambda w: (len(w), w))


def license_matches(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    templates: Sequence[tuple[str, str]] = TEMPLATES, share: float = SHARE, miss: float = MISS) -> DataFrame:
    """doc_id, license, share, start_word, n_words (of the window)."""
    table = spark.createDataFrame([(i, name, t) for i, (name, t) in enumerate(templates)], "template int, license string, t string")
    known = table.select("template", "license", words(F.col("t")).alias("w"), F.array_distinct(let(words(F.col("t")), shingles)).alias("wanted"))
    listed = [(r["w"], len(r["w"])) for r in known.collect()]  # as many as templates were given
    if any(n < SHINGLE for _, n in listed):
        raise ValueError(f"a template needs {SHINGLE} words or more")
    lengths = sorted({n for _, n in listed})

    def each_band(n: Column, hashes: Column) -> Column:
        out = F.array().cast("array<bigint>")
        for length in lengths:
            out = F.when(n == length, minima(hashes, bands(length, share, miss))).otherwise(out)
        return out

    known = known.withColumn("n", F.size("w"))
    drawn = known.select("template", "license", "wanted", "n", F.posexplode(each_band(F.col("n"), F.col("wanted"))).alias("band", "least"))

    source = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")
    )
    gate = F.lit(False)
    for word in sorted({key_word(w, share) for w, _ in listed}):
        gate = gate | F.contains(F.lower("text"), F.lit(word))

    def of_length(w: Column, h: Column, n: int) -> Column:
        step, width = stride(n), F.lit(n + stride(n) - SHINGLE + 1)
        keys = [F.lit(k) for k in sorted({key_word(t, share) for t, size in listed if size == n})]
        places = F.filter(upto(F.size(w) - 1, lambda i: i), lambda i: F.array_contains(F.array(*keys), F.get(w, i)))

        def around(p: Column) -> Column:
            first = F.greatest(F.lit(0), F.floor((p - n) / step).cast("int"))
            return F.transform(F.sequence(first, F.floor(p / step).cast("int")), lambda i: i * step)

        starts = F.array_distinct(F.flatten(F.transform(places, around)))
        return F.transform(
            F.filter(starts, lambda s: s < F.size(h)),
            lambda s: F.struct(F.lit(n).alias("n"), s.alias("start"), F.slice(h, s + 1, width).alias("held")),
        )

    def windows(w: Column) -> Column:
        return let(shingles(w), lambda h: F.concat(*[of_length(w, h, n) for n in lengths]))

    spread = source.where(gate).select("row", "doc_id", F.explode(let(words(F.col("text")), windows)).alias("win"))
    spread = spread.select("row", "doc_id", "win.n", "win.start", "win.held")
    spread = spread.select("row", "doc_id", "n", "start", "held", F.posexplode(each_band(F.col("n"), F.col("held"))).alias("band", "least"))
    # As many rows as templates times bands.
    found = spread.join(F.broadcast(drawn), ["n", "band", "least"])
    exact = F.size(F.array_intersect("wanted", "held")) / F.size("wanted")
    passed = found.select("row", "doc_id", "license", "n", "start", exact.alias("share")).where(F.col("share") >= share - 1e-9)
    best = passed.groupBy("row", "doc_id", "license").agg(F.max(F.struct("share", (-F.col("start")).alias("back"), "n")).alias("b"))
    place = F.struct(
        "license", F.col("b.share").alias("share"), (-F.col("b.back")).cast("int").alias("start_word"),
        (F.col("b.n") + F.greatest(F.lit(1), F.floor(F.col("b.n") / 4))).cast("int").alias("n_words"),
    )
    # At most one place for each license named in the templates.
    places = best.select("row", "doc_id", place.alias("p")).groupBy("row", "doc_id").agg(F.collect_list("p").alias("ps"))

    def better(x: Column, y: Column) -> Column:
        meet = (y["start_word"] < x["start_word"] + x["n_words"]) & (x["start_word"] < y["start_word"] + y["n_words"])
        return meet & (y["share"] > x["share"])

    chosen = let(F.col("ps"), lambda ps: F.filter(ps, lambda x: ~F.exists(ps, lambda y: better(x, y))))
    return places.select("doc_id", F.explode(chosen).alias("p")).select("doc_id", "p.*")
