"""License scans: MinHash bands over text windows, then exact containment (operator 7).

All DataFrame operations.  A template is a normalised word sequence (lower case, runs of
letters and digits).  Its k-word shingles are its set; a document window matches when
it holds at least ``containment`` of them.

Retrieval.  Windows are as long as a template, so a containment of c means a Jaccard
similarity of at least c / (2 - c).  Windows and templates get ``bands`` MinHash values,
one row per band: with similarity s a band agrees with probability s, and one of b with
``1 - (1 - s)^b``.  For c = 0.8, s is at least 2/3 and 16 bands miss fewer than 3 of 10^8;
an exact copy always collides.

Which windows: those that put one of the template's shingles where the template has
it, or the first window where that would begin before the text (a notice whose first words
are missing).  A window without any shingle of a template has containment 0, so none is lost.
Positions are first tested against a bit table of the templates' shingles (a superset,
8 megabytes at most for 16,000 shingles, growing with the templates, not the corpus), then looked up in a
map from shingle to its places in the templates, and the starts they give are made distinct before any window
is cut: a text that holds a template of n words carries about n hashes on, not n for each of its words.  The
bands choose the template, and the comparison at the end is exact.  No text is joined back or shuffled.

Nulls and ties: a null or wordless text matches nothing; a null or wordless template
is ignored; a template shorter than a shingle is one shingle of its own length; repeated
rows match each; equal templates match each; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, let, written

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 16

#: Short license notices as they are commonly written.
TEMPLATES = {
    "apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "mit-short": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "gpl-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-nc-4.0-short": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES "
        "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "all-rights-reserved-short": "All rights reserved.",
    "all-rights-reserved": "All rights reserved. No part of this publication may be reproduced without prior written permission.",
}


def license_words(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order; empty for null."""
    bare = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    bare = F.btrim(bare)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, " ", -1))


def _hashes(w: Column, k: int) -> Column:
    """A 64-bit hash per k-word shingle, folded word by word."""
    h = F.transform(w, lambda x: F.xxhash64(x))
    out = h
    for i in range(1, k):
        out = F.zip_with(F.slice(out, F.lit(1), F.greatest(F.size(h) - i, F.lit(0))), F.slice(h, F.lit(i + 1), F.size(h)), lambda a, b: F.xxhash64(a, b))
    return out


def signature(hashes: Column, bands: int) -> Column:
    """One MinHash value per band, tagged by the band."""

    def lowest(b: int) -> Column:  # a lambda of two arguments would get the position as the second
        return F.array_min(F.transform(hashes, lambda x: F.xxhash64(x, F.lit(b))))

    return F.array(*[F.xxhash64(F.lit(b), lowest(b)) for b in range(bands)])


def template_table(spark: SparkSession, templates: dict[str, str] | None = None) -> DataFrame:
    return spark.createDataFrame(list((templates or TEMPLATES).items()), "template string, text string")


def prepared(templates: DataFrame, shingle: int = SHINGLE, bands: int = BANDS) -> DataFrame:
    """``template, n, k, hashes, bands``: words, shingle length, distinct shingle hashes and MinHash values."""
    rows = templates.select(F.col("template"), license_words(F.col("text")).alias("w")).filter("size(w) > 0")
    rows = rows.withColumn("n", F.size("w")).withColumn("k", F.least(F.lit(shingle), F.size("w")))
    hashes = F.array().cast("array<bigint>")
    for k in range(1, shingle + 1):
        hashes = F.when(F.col("k") == k, F.array_distinct(_hashes(F.col("w"), k))).otherwise(hashes)
    return rows.withColumn("hashes", hashes).withColumn("bands", signature(F.col("hashes"), bands))


def _bits(spark: SparkSession, table: DataFrame) -> tuple[Column, int]:
    """A bit table, 64 to a long, with every template shingle's cell set; and its number of cells."""
    known = table.select(F.explode("hashes").alias("hash")).distinct()
    size = 1 << max(16, (512 * max(1, known.count())).bit_length())
    cell = F.pmod("hash", F.lit(size))
    on = known.select(F.shiftright(cell, 6).alias("id"), F.expr(f"shiftleft(1L, cast(pmod(hash, {size}) % 64 as int))").alias("bit")).groupBy("id").agg(F.bit_or("bit").alias("bits"))
    words = spark.range(size // 64).join(on, "id", "left").select(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")).alias("c"))
    return words.coalesce(1).agg(F.transform(F.sort_array(F.collect_list("c")), lambda c: c["bits"]).alias("b")).scalar(), size


def _windows(w: Column, lengths: list[int], size: int) -> Column:
    """The windows to look at: ``k, start, n, held``, where held are the shingle hashes of the window.

    A position whose shingle is set in the table ``bits`` is looked up in ``places`` (hash to packed places in
    templates); a start is packed with the window's length into one number, made distinct, and cut once.
    All shingle lengths share one split and one fold of a text.
    """

    def known(h: Column) -> Column:
        cell = F.pmod(h, F.lit(size))
        return F.getbit(F.col("bits")[F.shiftright(cell, 6).cast("int")], (cell % 64).cast("int")) == 1

    def pieces(h: Column, k: int) -> Column:
        at = F.when(F.size(h) > 0, F.sequence(F.lit(0), F.size(h) - 1)).otherwise(F.array().cast("array<int>"))
        none = F.array().cast("array<struct<n:int,at:int>>")

        def starts(p: Column) -> Column:
            found = F.coalesce(F.try_element_at("places", F.xxhash64(h[p], F.lit(k))), none)
            return F.transform(found, lambda o: F.greatest(p - o["at"], F.lit(0)).cast("bigint") * F.lit(1 << 31) + o["n"])

        packed = F.array_distinct(F.flatten(F.transform(F.filter(at, lambda p: known(h[p])), starts)))

        def cut(s: Column) -> Column:
            start, n = F.shiftright(s, 31).cast("int"), (s % F.lit(1 << 31)).cast("int")
            return F.struct(F.lit(k).alias("k"), start.alias("start"), n.alias("n"), F.slice(h, start + 1, n - k + 1).alias("held"))

        return F.transform(packed, cut)

    def folded(h: Column, out: Column, k: int) -> Column:
        """Pieces of every length from k up; ``out`` holds the hashes of k words, folded as in :func:`_hashes`."""
        own = [pieces(out, k)] if k in lengths else []
        if k < max(lengths):
            longer = F.zip_with(F.slice(out, F.lit(1), F.greatest(F.size(h) - k, F.lit(0))), F.slice(h, F.lit(k + 1), F.size(h)), lambda a, b: F.xxhash64(a, b))
            own.append(let(longer, lambda z: folded(h, z, k + 1)))
        return F.concat(*own) if len(own) > 1 else own[0]

    # No filter on the length: it would be pushed below and split the text twice.
    return let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: folded(h, h, 1))


def scan(
    docs: DataFrame, templates: DataFrame, shingle: int = SHINGLE, containment: float = CONTAINMENT, bands: int = BANDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, row, template, n_windows, start, containment`` per row of ``docs`` and template found in it.

    ``n_windows`` counts the windows that match, which overlap; ``start`` (in words from 0)
    and ``containment`` are of the fullest, the first of equally full ones.
    """
    spark = docs.sparkSession
    table = written(prepared(templates, shingle, bands), "license-templates")
    rows = docs.select(col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), license_words(col(text_col)).alias("w"))
    lengths = sorted(r["k"] for r in table.select("k").distinct().collect())  # at most `shingle` rows
    if not lengths:
        kind = docs.schema[id_col].dataType.simpleString()
        return spark.createDataFrame([], f"doc_id {kind}, row bigint, template string, n_windows bigint, start int, containment double")
    bits, size = _bits(spark, table)
    opens = table.select("n", "k", F.posexplode("hashes").alias("at", "hash")).select(F.xxhash64("hash", F.col("k").cast("int")).alias("key"), F.struct("n", "at").alias("o")).distinct()
    places = opens.groupBy("key").agg(F.collect_list("o").alias("o")).coalesce(1).agg(F.map_from_entries(F.collect_list(F.struct("key", "o"))).alias("m")).scalar()
    at = rows.withColumn("bits", bits).withColumn("places", places)
    windows = at.select("doc_id", "row", F.explode(_windows(F.col("w"), lengths, size)).alias("a")).select("doc_id", "row", "a.*")
    asked = windows.withColumn("band", F.explode(signature(F.array_distinct("held"), bands)))
    answers = table.select("template", "n", "k", "hashes", F.explode("bands").alias("band"))
    met = asked.join(answers, ["band", "n", "k"]).dropDuplicates(["row", "start", "template"])
    exact = F.size(F.array_intersect("held", "hashes")) / F.size("hashes")
    met = met.select("doc_id", "row", "template", "start", exact.alias("containment")).filter(F.col("containment") >= containment)
    best = F.max(F.struct("containment", (-F.col("start")).alias("before")))
    out = met.groupBy("row", "doc_id", "template").agg(F.count(F.lit(1)).alias("n_windows"), best.alias("b"))
    return out.select("doc_id", "row", "template", "n_windows", (-F.col("b.before")).alias("start"), F.col("b.containment").alias("containment"))
