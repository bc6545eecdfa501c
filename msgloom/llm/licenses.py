"""License scans: MinHash bands retrieve templates, shingle containment verifies them.

Templates fall in classes by their number of shingles: those of class L have more than L / 2 and
at most L. Overlapping windows of L shingles, L / 4 apart, run over the text. A window without any
shingle of a template can't hold one and gets no signature. The window next to a template with
containment 0.8 has similarity 0.3 or more to it, so of BANDS bands of one row at least one
collides with probability 1 - 0.7^16 > 0.996. A retrieved template counts when the window and a
quarter more on both sides hold at least CONTAINED of its shingles.

Null and empty texts hold no license. Repeated rows give repeated results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgloom.llm.common import if_small, lower_ascii, split_words, stored
from msgloom.operators.bounded import bounded, computed_once, small

SHINGLE = 5
CONTAINED = 0.8
BANDS = 16
MAX_TEMPLATES = 10_000
SEPARATORS = "[^0-9a-z]+"

# fixed values: notices by which licenses are granted
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
}


def notices(spark: SparkSession, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """(license, text), a row for each notice."""
    rows = [(name, text) for name, texts in templates.items() for text in texts]
    return spark.createDataFrame(rows, "license string, text string")


def _words(text: Column) -> Column:
    return split_words(lower_ascii(text), SEPARATORS)


def _hashed(words: Column) -> Column:
    """Hashes of all runs of SHINGLE words, in order; a text with fewer words has none."""
    n = F.greatest(F.size(words) - (SHINGLE - 1), F.lit(0))
    return F.transform(
        F.slice(words, F.lit(1), n), lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, SHINGLE)])
    )


def bands(hashes: Column) -> Column:
    """(band, least): the smallest value of a set of shingles under each of BANDS hash functions."""
    least = lambda b: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(b))))
    return F.array(*[F.struct(F.lit(b).alias("band"), least(b).alias("least")) for b in range(BANDS)])


def known_templates(texts: DataFrame) -> DataFrame:
    """Stored (license, held, class): shingles of notices (license, text) that have any."""
    rows = computed_once(texts, {"words": _words(F.col("text"))}, ["text"])
    rows = computed_once(rows, {"held": F.array_distinct(_hashed(F.col("words")))}, ["words"])
    rows = rows.filter(F.size("held") > 0)
    size = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("held").cast("double")))).cast("int")
    return stored(bounded(rows.select("license", "held", size.alias("class")), MAX_TEMPLATES, "templates"), "templates")


def _windows(size: int) -> Column:
    """Windows of one class that hold a shingle of a template: (class, at, window, around)."""
    step = max(1, size // 4)
    hashes = F.col("hashes")
    first = lambda p: F.greatest(F.ceil((p - (size - 1)) / step).cast("int"), F.lit(0))
    turns = F.flatten(F.transform("places", lambda p: F.sequence(first(p), F.floor(p / step).cast("int"))))
    return F.transform(
        F.array_distinct(turns),
        lambda k: F.struct(
            F.lit(size).alias("class"),
            k.alias("at"),
            F.slice(hashes, k * step + 1, F.lit(size)).alias("window"),
            F.slice(hashes, F.greatest((k - 1) * step, F.lit(0)) + 1, F.lit(size + 2 * step)).alias("around"),
        ),
    )


def found_licenses(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, text_hash, names, containment) of the rows that hold a template of known_templates."""
    classes = sorted(r["class"] for r in known.select("class").distinct().collect())  # powers of two
    if not classes:
        return docs.sparkSession.createDataFrame([], "doc_id long, text_hash long, names array<string>, containment double")
    every = known.select(F.explode("held").alias("s")).agg(F.collect_set("s")).scalar()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _words(F.col("text")).alias("words"))
    rows = computed_once(rows, {"w": F.col("words")}, ["words"])
    rows = computed_once(rows, {"hashes": _hashed(F.col("w"))}, ["w"])
    rows = computed_once(rows, {"present": F.array_intersect("hashes", every)}).filter(F.size("present") > 0)
    place = F.transform("hashes", lambda h, i: F.when(F.array_contains("present", h), i).otherwise(-1))
    rows = computed_once(rows, {"places": F.filter(place, lambda p: p >= 0)}, ["present"])
    rows = rows.select("doc_id", "text_hash", F.inline(F.concat(*[_windows(c) for c in classes])))
    rows = rows.select("doc_id", "text_hash", "class", "at", "around", F.inline(bands(F.col("window"))))
    keys = known.select("license", "held", "class", F.inline(bands(F.col("held"))))
    met = rows.join(small(keys, MAX_TEMPLATES * BANDS, "bands"), ["class", "band", "least"])
    met = met.select("doc_id", "text_hash", "at", "license", "held", "around").distinct()
    share = F.size(F.array_intersect("held", "around")) / F.size("held")
    met = met.withColumn("share", share).filter(F.col("share") >= CONTAINED)
    return met.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set("license")).alias("names"), F.max("share").alias("containment")
    )


def scan(docs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_licenses, licenses, containment) of every row of docs (doc_id, text).

    texts: notices (license, text), at most MAX_TEMPLATES. licenses: names in order, comma-joined;
    containment: the largest of a found notice, null without one.
    """
    known = known_templates(notices(docs.sparkSession) if texts is None else texts)
    found = stored(found_licenses(docs, known).withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"}), "licenses")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    same = rows["doc_id"].eqNullSafe(F.col("_doc")) & (rows["text_hash"] == F.col("_hash"))
    names = F.coalesce("names", F.array().cast("array<string>"))
    return rows.join(if_small(found), same, "left").select(
        "doc_id",
        F.size(names).cast("long").alias("n_licenses"),
        F.array_join(names, ",").alias("licenses"),
        "containment",
    )
