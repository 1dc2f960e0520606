"""License scan: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies.

A template matches a text if at least ``CONTAINED`` of its 5-word shingles occur in it. Windows are runs of ``WINDOW``
shingles, half overlapping in texts and at every position in templates; ``BANDS`` bands of ``ROWS`` minima give
windows of similarity s a common key with probability 1 - (1 - s^ROWS)^BANDS, over 99.9 % at 0.8. Templates of fewer
shingles than a window have windows of one shingle, which any shared shingle retrieves. A bit map of
fixed size tells which shingles of a text may be a template's; only these, and the keys of windows that hold one, are kept.

Column functions only. Defined results: null and empty texts match nothing; letter case and punctuation are ignored;
a text that holds a template several times has one row for it; repeated rows have their own rows; templates of fewer
than five words are one shingle of all their words and match only a text of just these; an empty table of
texts or templates gives no rows; very long texts are scanned whole. Columns other than record and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stillhouse.functions.once import with_once
from stillhouse.llm.common import stored
from stillhouse.llm.fingerprints import SHINGLE, with_shingles

WINDOW = 8
BANDS = 8
ROWS = 2
CONTAINED = 0.8
SLOT_BITS = 20

# Wording of public licences and of common notices.
TEMPLATES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
           "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
           "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
           "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                  "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
                  "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
                  "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
                  "the specific language governing permissions and limitations under the License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
               "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
               "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
               "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
               "License for more details.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                    "following conditions are met: Redistributions of source code must retain the above copyright notice, this "
                    "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
                    "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
                    "materials provided with the distribution.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
           "provided that the above copyright notice and this permission notice appear in all copies.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
}


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES.items()), "license string, text string")


def words(text: Column) -> Column:
    plain = F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _keys(window: Column, turned: int) -> Column:
    """One key per band from the window's hashes."""
    def least(row: int) -> Column:
        return F.array_min(F.transform(window, lambda h: F.xxhash64(h, F.lit(turned + row))))

    return F.array(*[F.xxhash64(F.lit(b), *[least(b * ROWS + r) for r in range(ROWS)]) for b in range(BANDS)])


def _template_keys(known: DataFrame) -> DataFrame:
    """(license, key): the keys of each template's windows, at every position."""
    starts = F.sequence(F.lit(0), F.size("__shingles") - WINDOW)
    large = known.filter(F.size("__shingles") >= WINDOW).select("*", F.explode(starts).alias("__start"))
    window = with_once(large, "__window", F.slice("__shingles", F.col("__start") + 1, F.lit(WINDOW)))
    keys = window.select("license", F.explode(_keys(F.col("__window"), 100)).alias("key"))
    small = known.filter(F.size("__shingles") < WINDOW).select("license", F.explode("__shingles").alias("h"))
    return keys.unionByName(small.select("license", _single(F.col("h")).alias("key"))).distinct()


def _single(shingle: Column) -> Column:
    return F.xxhash64(F.lit(-1), shingle)


def _text_keys() -> Column:
    """Distinct keys of a text's windows and shingles. The minima of a window that agrees with a template's are
    shingles of the template, so windows without a hit need no keys."""
    stride = WINDOW // 2
    last = F.greatest(F.lit(0), F.size("__shingles") - WINDOW)
    over = F.flatten(F.transform("__hits", lambda x: F.array(*[x["at"] - x["at"] % stride - back for back in (0, stride)], last)))
    starts = F.filter(F.array_distinct(over), lambda s: (s >= 0) & (s <= last))
    windows = F.transform(starts, lambda s: F.slice("__shingles", s + 1, F.lit(WINDOW)))
    keys = F.flatten(F.transform(windows, lambda w: _keys(w, 100)))
    return F.array_distinct(F.concat(keys, F.transform("__hits", lambda x: _single(x["h"]))))


def scan(docs: DataFrame, templates: DataFrame | None = None, record: str = "doc_id", text: str = "text",
         contained: float = CONTAINED) -> DataFrame:
    """(record, license, containment, first_word, last_word): a row per text and template that matches.

    ``first_word`` and ``last_word`` bound the words that share shingles with the template.
    """
    spark = docs.sparkSession
    given = (default_templates(spark) if templates is None else templates).select("license", F.col("text").alias("__text"))
    known = with_shingles(given, words(F.col("__text")), "__shingles").drop("__text").filter(F.size("__shingles") > 0)
    known = stored(known.withColumn("__shingles", F.array_distinct("__shingles")), "templates")

    def slot(h: Column) -> Column:
        return F.shiftrightunsigned(h, 64 - SLOT_BITS)

    def bit(h: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), slot(h).bitwiseAND(F.lit(63)).cast("int"))

    each = known.select(F.explode("__shingles").alias("h"))
    filled = each.groupBy(F.shiftright(slot(F.col("h")), 6).cast("int").alias("word")).agg(F.bit_or(bit(F.col("h"))).alias("bits"))
    bits = ["0"] * (1 << (SLOT_BITS - 6))
    for row in filled.collect():  # as many rows as the map has words at most
        bits[row["word"]] = str(row["bits"])
    # One string that the optimizer folds into one array.
    words_of_map = F.split(F.lit(",".join(bits)), ",").cast("array<bigint>")

    def admitted(h: Column) -> Column:
        return F.get(words_of_map, F.shiftright(slot(h), 6).cast("int")).bitwiseAND(bit(h)) != 0

    texts = with_shingles(docs.select(F.col(record).alias("__record"), F.col(text).alias("__text")), words(F.col("__text")), "__shingles").drop("__text")
    at_hits = F.transform("__shingles", lambda h, i: F.when(admitted(h), F.struct(i.alias("at"), h.alias("h"))))
    hits = with_once(texts, "__hits", F.array_compact(at_hits)).filter(F.size("__hits") > 0)
    # Of a text only the shingles that may be a template's are kept, and the keys of the windows around them.
    kept = hits.select("__record", "__hits", _text_keys().alias("__keys")).withColumn("__row", F.monotonically_increasing_id())
    texts = stored(kept, "texts")

    text_keys = texts.select("__row", F.explode("__keys").alias("key"))
    retrieved = text_keys.join(_template_keys(known), "key").select("__row", "license").distinct()

    pairs = retrieved.join(known.withColumnRenamed("__shingles", "__template"), "license").join(texts.drop("__keys"), "__row")
    both = F.size(F.array_intersect("__template", F.transform("__hits", lambda x: x["h"])))
    share = with_once(pairs, "containment", both / F.size("__template").cast("double")).filter(F.col("containment") >= contained)
    at = F.transform(F.filter("__hits", lambda x: F.array_contains("__template", x["h"])), lambda x: x["at"])
    found = with_once(share, "__at", at)
    return found.select(
        F.col("__record").alias(record), "license", "containment", F.array_min("__at").cast("bigint").alias("first_word"),
        (F.array_max("__at") + SHINGLE - 1).cast("bigint").alias("last_word"),
    )
