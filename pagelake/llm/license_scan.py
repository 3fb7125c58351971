"""License scans: MinHash bands over overlapping windows find notices, exact shingle containment confirms them.

Everything is a DataFrame expression. A text is looked at closely only if it has a cue word; cue words stand in over
a fifth of every notice's shingles, so a text that holds four fifths of a notice has one. Its shingles are hashed once;
windows as long as each notice, around shingles that some notice has, are hashed to bands; notices' bands are a fixed
small table. A pair at Jaccard similarity
s meets in a band with probability 1 - (1 - s ** ROWS) ** BANDS: over 0.99999 at 0.8, and 0.98 at 0.5.
"""

from __future__ import annotations

import re

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.llm.common import column

SHINGLE, BANDS, ROWS, CONTAINED = 5, 16, 2, 0.8
#: Places of a text that are cut to windows together.
SEGMENT = 1_024
WORD = r"[\p{L}\p{N}]+(?:[.\-][\p{L}\p{N}]+)*"
#: Words that begin so are cues.
CUES = ("licen", "copyright", "warrant", "redistribut", "permission", "software", "reserved")

# The usual wording of public license notices.
NOTICES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "gpl-2.0": [
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "lgpl-2.1": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "bsd-3-clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that redistributions of source code retain the above copyright notice.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "bsd-2-clause": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "proprietary": ["All rights reserved. No part of this publication may be reproduced without prior written permission of the publisher."],
}
#: Notices of fewer words than a shingle: each is one shingle, all its words in their order.
SHORT_NOTICES = {"proprietary": ["All rights reserved."]}


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:[.\-][^\W_]+)*", text.lower())


def templates() -> list[tuple[int, str, list[str]]]:
    """(number, license, words) of every notice of a shingle or more."""
    return [(k, name, words_of(text)) for k, (name, text) in enumerate((n, t) for n, ts in NOTICES.items() for t in ts)]


def all_templates() -> list[tuple[int, str, list[str]]]:
    """templates(), then the short notices."""
    long = templates()
    return long + [(len(long) + k, name, words_of(text)) for k, (name, text) in enumerate((n, t) for n, ts in SHORT_NOTICES.items() for t in ts)]


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def _hashes(words: Column, width: int) -> Column:
    """Hashes of the shingles of a word array, in order; an array too short has none."""
    n = F.size(words) - (width - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.xxhash64(F.array_join(F.slice(words, i, F.lit(width)), " ")))).otherwise(F.array().cast("array<bigint>"))


def widths() -> list[int]:
    """Words in a shingle: all of a notice that has fewer than SHINGLE."""
    return sorted({min(SHINGLE, len(w)) for _, _, w in all_templates()})


def known_shingles(width: int, words: int | None = None) -> list[int]:
    """Hashes, as Spark makes them, of all notices' shingles of a width, or of those of so many words: a fixed, small list."""
    some = [w for _, _, w in all_templates() if min(SHINGLE, len(w)) == width and words in (None, len(w))]
    text = [" ".join(w[i : i + width]) for w in some for i in range(len(w) - width + 1)]
    return sorted({(xxhash.xxh64_intdigest(t.encode(), seed=42) ^ (1 << 63)) - (1 << 63) for t in text})


def _bands(shingles: Column) -> Column:
    """One hash for each band: that of its ROWS minima, each over its own rehash of the shingles."""
    least = lambda k: F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(k))))
    return F.array(*[F.xxhash64(F.lit(b), *[least(b * ROWS + r) for r in range(ROWS)]) for b in range(BANDS)])


def template_table(spark: SparkSession) -> DataFrame:
    """template, license, n_words, shingles, bands: one row per notice, a fixed number."""
    raw = spark.createDataFrame([(k, name, w) for k, name, w in all_templates()], "template int, license string, words array<string>")
    sh = F.coalesce(*[F.when(F.least(F.size("words"), F.lit(SHINGLE)) == w, _hashes(F.col("words"), w)) for w in widths()])
    return raw.select("template", "license", F.size("words").alias("n_words"), sh.alias("shingles")).withColumn("bands", _bands(F.col("shingles")))


def _segments(h: Column, width: int) -> Column:
    """The hashes of a text in stretches of SEGMENT, with what the windows that start in each reach before and after:
    array of (width, first, base, h), h from place `base` on. Stretches without a notice's shingle are left out.
    """
    pad = max(len(w) for _, _, w in all_templates())
    last = F.floor(F.greatest(F.size(h) - 1, F.lit(0)) / SEGMENT).cast("int")
    base = lambda k: F.greatest(k * SEGMENT - pad, F.lit(0))
    made = F.transform(F.sequence(F.lit(0), last), lambda k: F.struct(F.lit(width).alias("width"), (k * SEGMENT).alias("first"), base(k).alias("base"), F.slice(h, base(k) + 1, F.lit(SEGMENT + 3 * pad)).alias("h")))
    return F.filter(made, lambda x: F.exists(x["h"], lambda v: v.isin(known_shingles(width))))


def _windows(first: Column, base: Column, h: Column, lengths: list[int], width: int) -> Column:
    """Windows for notices of these lengths that start in a stretch, around the shingles that some notice of that length
    has: array of start, n_words, bands, around (the shingles of the window and as many words before and after it).

    A window without such a shingle shares no minimum with a notice of its length, so no band either. Starts lie on a grid of a tenth of the length. All is cut from h here, so that no row carries the text further on.
    """

    def of(n: int) -> Column:
        known = known_shingles(width, n)
        spots = F.filter(F.transform(h, lambda x, i: F.when(x.isin(known), base + i)), lambda i: i.isNotNull())
        step = max(1, n // 10)
        near = lambda i: F.sequence(F.floor(F.greatest(i - (n - width), F.lit(0)) / step).cast("int"), F.floor(i / step).cast("int"))
        starts = F.transform(F.array_distinct(F.flatten(F.transform(spots, near))), lambda k: k * step)
        starts = F.filter(starts, lambda s: (s >= first) & (s < first + SEGMENT))
        cut = lambda s: F.slice(h, s - base + 1, F.lit(n - width + 1))
        around = lambda s: F.slice(h, F.greatest(s - n, F.lit(0)) - base + 1, F.lit(3 * n - width + 1))
        return F.transform(starts, lambda s: F.struct(s.alias("start"), F.lit(n).alias("n_words"), _bands(cut(s)).alias("bands"), around(s).alias("around")))

    return F.flatten(F.array(*map(of, lengths)))


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of docs and license found: doc_id, license, containment (best notice's), first_word, n_windows.

    Null and empty texts, and texts without a notice, give no row. Repeated rows give their rows each, a null doc_id stays
    null. Texts are read whole, in time and memory that grow with their length; other columns of any name don't matter. A
    notice counts from CONTAINED of its word shingles on, whatever the case, punctuation and line breaks between words.
    """
    spark = docs.sparkSession
    known = template_table(spark)
    cue = "(?i)(" + "|".join(CUES) + ")"
    rows = docs.select(column(docs, "doc_id", "bigint"), column(docs, "text", "string")).filter(F.col("text").rlike(cue))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", _words(F.col("text")).alias("words"))
    rows = rows.select("row", "doc_id", *[_hashes(F.col("words"), w).alias(f"h{w}") for w in widths()])
    lengths = {w: sorted({len(t) for _, _, t in all_templates() if min(SHINGLE, len(t)) == w}) for w in widths()}
    stretches = rows.select("row", "doc_id", F.explode(F.concat(*[_segments(F.col(f"h{w}"), w) for w in widths()])).alias("s")).select("row", "doc_id", "s.*")
    every = F.coalesce(*[F.when(F.col("width") == w, _windows(F.col("first"), F.col("base"), F.col("h"), lengths[w], w)) for w in widths()])
    cut = stretches.select("row", "doc_id", F.explode(every).alias("w")).select("row", "doc_id", "w.start", "w.n_words", "w.around", F.posexplode("w.bands").alias("band", "value"))
    index = known.select("template", F.col("n_words").alias("t_words"), F.posexplode("bands").alias("t_band", "t_value"))
    met = cut.join(F.broadcast(index), (F.col("band") == F.col("t_band")) & (F.col("value") == F.col("t_value")) & (F.col("n_words") == F.col("t_words")))
    met = met.dropDuplicates(["row", "start", "template"]).join(F.broadcast(known.select("template", "license", "shingles")), "template")
    share = F.size(F.array_intersect("around", "shingles")) / F.size(F.array_distinct("shingles"))
    sure = met.withColumn("containment", share).filter(F.col("containment") >= CONTAINED)
    return sure.groupBy("row", "license").agg(F.first("doc_id").alias("doc_id"), F.max("containment").alias("containment"), F.min("start").cast("bigint").alias("first_word"), F.countDistinct("start").alias("n_windows")).select("doc_id", "license", "containment", "first_word", "n_windows")
