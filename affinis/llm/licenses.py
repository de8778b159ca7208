"""License scans: MinHash bands over overlapping windows, then exact shingle containment."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.llm.tables import let
from affinis.session import cut_lineage

#: Words of a shingle, least share of a template's shingles, chance that a match is retrieved.
SHINGLE, CONTAINED, RECALL = 5, 0.8, 0.999

# License statements and notices, as they stand in published works.
TEMPLATES = {
    "mit-statement": "Released under the MIT License.",
    "apache-2.0-statement": "Licensed under the Apache License, Version 2.0.",
    "gpl-3-statement": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2-statement": "This work is licensed under the GNU General Public License, version 2.",
    "cc-by-nc-4.0-statement": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-statement": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-statement": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "bsd-statement": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "mit-notice": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "isc-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-2-clause-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "unlicense-notice": "This is free and unencumbered software released into the public domain.",
}


def scan_words(text: Column) -> Column:
    """Runs of letters and digits, lower-cased; none for null."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda x: x != "")


def shingle_texts(words: Column) -> Column:
    """Runs of ``SHINGLE`` words, joined by a blank."""
    places = F.sequence(F.lit(1), F.size(words) - SHINGLE + 1)
    made = F.transform(places, lambda i: F.array_join(F.slice(words, i, SHINGLE), " "))
    return F.when(F.size(words) >= SHINGLE, made).otherwise(F.array().cast("array<string>"))


def shingle_hashes(words: Column) -> Column:
    """A hash of each run of ``SHINGLE`` words."""

    def of(h: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(h) - SHINGLE)
        return F.transform(places, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(SHINGLE)]))

    made = let(F.transform(words, lambda w: F.xxhash64(w)), of)
    return F.when(F.size(words) >= SHINGLE, made).otherwise(F.array().cast("array<bigint>"))


def band_count() -> int:
    """Bands of one hash each, so that a match is retrieved with probability ``RECALL``.

    A template of m shingles is looked for in windows of 2 m at every m / 2: a place of up to
    1.5 m lies inside one. If the window has the share c of the template's shingles, the Jaccard
    similarity is c m / (2 m + (1 - c) m) at least, which is the chance that one band agrees.
    """
    least = CONTAINED / (3 - CONTAINED)
    return math.ceil(math.log(1 - RECALL) / math.log(1 - least))


def _minima(hashes: Column, bands: int) -> list[Column]:
    """The smallest hash of every permutation."""
    return [F.array_min(_permuted(hashes, i)) for i in range(bands)]


def _permuted(hashes: Column, i: int) -> Column:
    return F.transform(hashes, lambda h: F.xxhash64(h, F.lit(i)))


def _templates(spark: SparkSession, templates: dict[str, str], bands: int) -> DataFrame:
    """Words, shingles, size and band values of the templates; the list is the caller's."""
    rows = spark.createDataFrame(sorted(templates.items()) or [("", "")], "license string, template string")
    rows = rows.filter(F.lit(bool(templates))).withColumn("words", scan_words(F.col("template")))
    made = rows.select("license", F.array_distinct(shingle_texts(F.col("words"))).alias("shingles"), shingle_hashes(F.col("words")).alias("h"))
    # the shingle behind each minimum
    pivots = [F.get("h", F.array_position(_permuted(F.col("h"), i), F.array_min(_permuted(F.col("h"), i))).cast("int") - 1) for i in range(bands)]
    return made.filter(F.size("shingles") > 0).select(
        "license", "shingles", F.size("h").alias("m"), F.array(*_minima(F.col("h"), bands)).alias("minima"), F.array(*pivots).alias("pivots")
    )


def scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, license, containment, start_word)``: templates that a document holds.

    A template matches where a window has ``CONTAINED`` of its shingles or more; the best window
    of a template, then the first, is reported with the word at which it starts. Windows overlap
    (see ``band_count``) and cover whole texts. A band of a window can agree with a template's
    only if the window has the shingle that is the template's minimum, so windows without any of
    these shingles are passed over; the others get all minima, meet templates by equal bands, and
    the shingles themselves are compared.

    Null and empty texts, texts of under five words, and templates of under five words match
    nothing. Null ids are reported as null; rows that share an id share results; other
    columns are ignored.
    """
    spark = docs.sparkSession
    bands = band_count()
    known = _templates(spark, TEMPLATES if templates is None else templates, bands)
    pivots: dict[int, set[int]] = {}
    for r in known.select("m", "pivots").collect():  # one row a template
        pivots.setdefault(r.m, set()).update(r.pivots)
    schema = f"`{id_col}` bigint, license string, containment double, start_word int"
    if not pivots:
        return spark.createDataFrame([], schema)
    every = sorted(set().union(*pivots.values()))

    def starts(p: Column, h: Column, m: int) -> Column:
        """Windows of a template's size that hold place ``p``, if its shingle is one of theirs."""
        step = max(1, m // 2)
        first = F.greatest(F.ceil((p - 2 * m + 1) / step), F.lit(0)).cast("int")
        made = F.transform(F.sequence(first, F.floor(p / step).cast("int")), lambda k: F.struct(F.lit(m).alias("m"), (k * step).alias("s")))
        return F.when(h.isin(sorted(pivots[m])), made).otherwise(F.array().cast("array<struct<m:int,s:int>>"))

    def windows(words: Column) -> Column:
        def around(h: Column) -> Column:
            hits = F.filter(F.transform(h, lambda x, i: F.when(x.isin(every), F.struct(x.alias("h"), i.alias("p")))), lambda x: x.isNotNull())
            each = F.flatten(F.transform(hits, lambda x: F.concat(*[starts(x["p"], x["h"], m) for m in sorted(pivots)])))
            return F.transform(
                F.array_distinct(each),
                lambda x: F.struct(x["m"].alias("m"), x["s"].alias("s"), F.slice(words, x["s"] + 1, 2 * x["m"] + SHINGLE - 1).alias("words")),
            )

        return let(shingle_hashes(words), around)

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), let(scan_words(F.col(text_col).cast("string")), windows).alias("w"))
    found = cut_lineage(rows.select("id", F.explode("w").alias("w")).select("id", "w.m", "w.s", "w.words"))
    signed = found.withColumn("h", shingle_hashes(F.col("words")))
    banded = signed.select("id", "m", "s", "words", F.posexplode(F.array(*_minima(F.col("h"), bands))).alias("band", "low"))
    keys = known.select("license", "shingles", "m", F.posexplode("minima").alias("band", "low"))
    met = banded.join(keys, ["m", "band", "low"]).select("id", "s", "words", "license", "shingles").distinct()
    shared = F.size(F.array_intersect("shingles", shingle_texts(F.col("words")))) / F.size("shingles")
    checked = met.select("id", "license", "s", shared.alias("c")).filter(F.col("c") >= CONTAINED)
    best = F.min(F.struct((-F.col("c")).alias("c"), "s")).alias("b")
    return checked.groupBy("id", "license").agg(best).select(
        F.col("id").alias(id_col), "license", (-F.col("b.c")).alias("containment"), F.col("b.s").alias("start_word")
    )
