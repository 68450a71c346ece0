"""Licence scan (operator 3), in DataFrame functions only.

Method: template-sized, overlapping windows of the documents (``anchors``) and the templates get
MinHash signatures over five-word shingles, cut into ``bands`` bands of ``rows`` minima; windows
and templates that share a band are candidates. A window that contains 0.8 of an equally long
template has Jaccard similarity 2/3 or more, so twelve bands of two find it with probability
1 - (1 - (2/3)^2)^12 = 0.9991 and an exact copy always. Candidates are checked exactly:
the share of the template's shingles that the window contains must reach ``containment``. A
template of fewer than five words is one shingle of all its words. Of windows that overlap by
half of the shorter one, only the licence with most shingles found stays, so that licences
worded alike don't stand for each other.

Defined cases: null, empty and blank texts hold nothing, and blank templates match nothing; very long texts are scanned whole; a licence found at several places or under
several templates of one name gives one row, the best; rows with the same id and text are one
document; null ids take part; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popweave.llm.anchors import hashed, windows, words
from popweave.llm.common import prepare, read
from popweave.session import materialize

#: Full texts, one file a licence, named by its SPDX name.
TEXTS = Path(__file__).parent / "licenses"
#: The usual short notices, by SPDX name.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("LicenseRef-All-Rights-Reserved", "All rights reserved."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("EPL-1.0", "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def band_keys(sets: DataFrame, key: str, bands: int, rows: int) -> DataFrame:
    """(key, band) with one hash per band of the MinHash signature of the shingles in ``h``."""
    minima = (sets.select(key, F.explode("h").alias("g"))
              .groupBy(key).agg(*(F.min(F.xxhash64(F.lit(j), "g")).alias(f"m{j}") for j in range(bands * rows))))
    return minima.select(key, F.explode(F.array(*(
        F.xxhash64(F.lit(b), *(f"m{b * rows + r}" for r in range(rows))) for b in range(bands)))).alias("band"))


def scan(docs: DataFrame, templates: DataFrame, containment: float = 0.8, bands: int = 12, rows: int = 2, k: int = 5,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, license, containment, start): each document and licence found in it; ``templates``
    has ``license`` and ``text``; ``start`` is the first word of the best window."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.filter("text IS NOT NULL").withColumn("th", F.xxhash64("text"))
    named = templates.select("license", "text").withColumn("w", F.size(words(F.col("text")))).filter(words(F.col("text"))[0] != "")
    short = [r.w for r in named.filter(F.col("w") < k).select("w").distinct().orderBy("w").collect()]
    each = [held(texts, named.filter(F.col("w") == m), containment, bands, rows, m) for m in short]
    found = reduce(DataFrame.unionByName, each, held(texts, named.filter(F.col("w") >= k), containment, bands, rows, k))
    # a document's places: bounded by its windows
    most = found.groupBy("id", "th", "license", "start").agg(F.max(F.struct("hits", "share", "end")).alias("m"))
    places = most.groupBy("id", "th").agg(F.collect_list(F.struct("license", "start", "m.hits", "m.share", "m.end")).alias("p"))

    def beaten(x):
        def by(o):
            common = F.least(o.end, x.end) - F.greatest(o.start, x.start)
            rank = lambda y: F.struct(-y.hits, -y.share, y.license)
            return ((o.license != x.license) & (common * 2 >= F.least(o.end - o.start, x.end - x.start)) & (common > 0)
                    & (rank(o) < rank(x)))
        return F.exists("p", by)

    kept = places.select("id", "th", F.explode(F.filter("p", lambda x: ~beaten(x))).alias("f"))
    best = F.min(F.struct((-F.col("f.share")).alias("s"), F.col("f.start").alias("start"))).alias("b")
    return (kept.groupBy("id", "th", F.col("f.license").alias("license")).agg(best)
            .select("id", "th", "license", (-F.col("b.s")).alias("containment"), F.col("b.start").alias("start")))


def held(texts: DataFrame, templates: DataFrame, containment: float, bands: int, rows: int, k: int) -> DataFrame:
    """(id, th, license, start, end, hits, share): the windows of ``texts`` that hold a template,
    with their first and last words, by shingles of ``k`` words."""
    known = materialize(hashed(templates, "text", k, "license").distinct()
                        .withColumn("tk", F.xxhash64("license", "h")), "templates").filter("h IS NOT NULL")
    wins = materialize(windows(texts, known, k, containment), "windows")
    pairs = band_keys(wins, "win", bands, rows).join(band_keys(known, "tk", bands, rows), "band").select("win", "tk").distinct()
    own = wins.select("win", "id", "th", "start", (F.col("start") + F.col("n") + (k - 1)).alias("end"), F.col("h").alias("hw"))
    named = known.select("tk", "license", F.array_distinct("h").alias("ht"))
    hits = F.size(F.array_intersect("ht", "hw"))
    return (pairs.join(own, "win").join(named, "tk").withColumn("hits", hits).withColumn("share", F.col("hits") / F.size("ht"))
            .filter(F.col("share") >= containment).select("id", "th", "license", "start", "end", "hits", "share"))


def known_licenses() -> list[tuple[str, str]]:
    """(name, text) of all templates: the notices and the full texts."""
    return [*NOTICES, *((f.stem, f.read_text("utf-8")) for f in sorted(TEXTS.glob("*.txt")))]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    templates = spark.createDataFrame(known_licenses(), "license string, text string")
    return scan(read(spark, sf_dir, "documents"), templates).select(
        F.col("id").alias("doc_id"), "license", F.round("containment", 6).alias("containment"),
        F.col("start").alias("start_word"))
