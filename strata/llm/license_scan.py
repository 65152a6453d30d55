"""Licence scan: Dice coefficient over word bigrams against licence templates.

A text is its sequence of normalised words, so line breaks, comment marks and
punctuation do not matter. Wherever an anchor word of a template stands, the window of the
template's length is looked at in which that word has its place in the template; the
window matches if the Dice coefficient of its distinct bigrams and the template's
reaches the threshold, and of overlapping matches of one template the best stays.
Anchor words are chosen so that a window that reaches the threshold holds one.

Two bounds prune before any bigram is built: texts without any anchor word are left out,
and of each template only windows that its anchors place are cut, whose number of
bigrams has to lie between q t / (2 - q) and t (2 - q) / q for a coefficient of q with
t template bigrams. Nothing is shuffled; all of it is SQL functions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Short licence notices as they stand in files.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "This project is licensed under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-2.1": "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "BSD-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "BSD-disclaimer": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
}
MIN_PERCENT = 80
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Normalised words: runs of ASCII letters and digits, letters folded."""
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit("[a-z0-9]+"), F.lit(0))


def bigrams(word: Column) -> Column:
    """Hashes of the distinct word pairs."""
    n = F.greatest(F.size(word) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(word, 1, n), F.slice(word, F.lit(2), n), lambda a, b: F.xxhash64(a, b)))


def anchor_words(templates: dict[str, str], min_percent: int) -> list[str]:
    """Words of which a unit that reaches the threshold with some template has one.

    Such a unit holds at least percent * t / (200 - percent) of the t bigrams of the
    template. Of any set of bigrams that is larger than what may be missing, one is
    therefore present, and with it both its words; the sets are chosen so that
    they share few, long words.
    """
    chosen: set[str] = set()
    for text in templates.values():
        word = re.findall("[a-z0-9]+", text.translate(str.maketrans(_UPPER, _LOWER)))
        pairs = set(zip(word, word[1:]))
        needed = len(pairs) - -(-min_percent * len(pairs) // (200 - min_percent)) + 1
        covered: set[tuple[str, str]] = set()
        # Long words first; a number is rarer in prose than a word of a few letters.
        for w in sorted(set(word), key=lambda w: (w not in chosen, -max(len(w), 5 * w.isdigit()), w)):
            if len(covered) >= min(needed, len(pairs)):
                break
            covered |= {p for p in pairs if w in p}
            chosen.add(w)
    return sorted(chosen)


def has_anchor(text: Column, anchors: list[str]) -> Column:
    """True where some anchor word occurs as a substring of the lower-cased text: a superset of the texts that can match."""
    low = F.lower(text)
    test = F.lit(False)
    # A word that contains another anchor word adds nothing to a substring test.
    for w in (w for w in anchors if not any(o != w and o in w for o in anchors)):
        test = test | F.contains(low, F.lit(w))
    return test


def template_words(templates: dict[str, str]) -> dict[str, list[str]]:
    """The normalised words of each template, by its name."""
    return {k: re.findall("[a-z0-9]+", v.translate(str.maketrans(_UPPER, _LOWER))) for k, v in sorted(templates.items())}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, min_percent: int = MIN_PERCENT) -> DataFrame:
    """One row per window and template with a Dice coefficient of at least
    `min_percent` percent: id, `license_id`, `start` (words before the window; below 0
    where the text begins inside the template), `matched` (the window's normalised
    words), `common`, `unit_bigrams`, `template_bigrams`, `dice`.

    Of overlapping windows of one template that match, one that another exceeds (or
    equals and precedes) is left out. A null, empty or one-word text has no bigram and
    no match; repeated rows give repeated results; an empty table gives none. Only
    the two named columns are read. Templates of one word cannot match.
    """
    spark = docs.sparkSession
    named = {k: w for k, w in template_words(templates or TEMPLATES).items() if len(w) > 1}
    anchors = anchor_words({k: " ".join(w) for k, w in named.items()}, min_percent)
    # The templates' own hashes: a few short arrays, then literals of the plan.
    one = spark.range(1).select(*[bigrams(F.array(*[F.lit(x) for x in w])).alias(f"t{i}") for i, w in enumerate(named.values())]).first()
    grams = F.array(*[F.array(*[F.lit(x).cast("bigint") for x in g]) for g in one])
    length = F.array(*[F.lit(len(w)) for w in named.values()])
    size = F.array(*[F.lit(len(g)) for g in one])
    low, high = (F.array(*[F.lit(f(len(g))) for g in one]) for f in (lambda t: -(-t * min_percent // (200 - min_percent)), lambda t: t * (200 - min_percent) // min_percent))
    places = F.array(*[F.struct(F.lit(x).alias("word"), F.lit(no).alias("no"), F.lit(o).alias("o")) for no, w in enumerate(named.values()) for o, x in enumerate(w) if x in anchors])
    kept = F.array(*[F.lit(x) for x in anchors])

    rows = docs.where(has_anchor(F.col(text_col), anchors)).select(F.col(id_col).alias("__id"), words(F.col(text_col)).alias("__w"))
    at = F.filter(F.transform("__w", lambda x, i: F.struct(x.alias("word"), i.alias("at"))), lambda p: F.array_contains(kept, p["word"]))
    placed = F.flatten(F.transform(at, lambda p: F.transform(F.filter(places, lambda t: t["word"] == p["word"]), lambda t: F.struct(t["no"].alias("no"), (p["at"] - t["o"]).alias("start")))))
    rows = rows.withColumn("__c", F.filter(F.array_distinct(placed), lambda c: c["start"] > -F.get(length, c["no"])))
    cut = lambda c: F.slice("__w", F.greatest(c["start"], F.lit(0)) + 1, F.get(length, c["no"]) + F.least(c["start"], F.lit(0)))
    found = F.transform("__c", lambda c: F.struct(c["no"].alias("no"), c["start"].alias("start"), bigrams(cut(c)).alias("g")))
    found = F.filter(found, lambda x: (F.size(x["g"]) >= F.get(low, x["no"])) & (F.size(x["g"]) <= F.get(high, x["no"])))
    found = F.transform(found, lambda x: F.struct(x["no"].alias("no"), x["start"].alias("start"), F.size(x["g"]).alias("unit"), F.size(F.array_intersect(x["g"], F.get(grams, x["no"]))).alias("common")))
    total = lambda x: x["unit"] + F.get(size, x["no"])
    rows = rows.withColumn("__h", F.filter(found, lambda x: x["common"] * 200 >= total(x) * min_percent))
    # Coefficients of one template compared crosswise, in integers.
    ahead = lambda y, x: (y["common"] * total(x) > x["common"] * total(y)) | ((y["common"] * total(x) == x["common"] * total(y)) & (y["start"] < x["start"]))
    beaten = lambda x: F.exists("__h", lambda y: (y["no"] == x["no"]) & (F.abs(y["start"] - x["start"]) < F.get(length, x["no"])) & ahead(y, x))
    best = rows.withColumn("__x", F.explode(F.filter("__h", lambda x: ~beaten(x))))
    x, names = F.col("__x"), F.array(*[F.lit(k) for k in named])
    return best.select(
        F.col("__id").alias(id_col), F.get(names, x["no"]).alias("license_id"), x["start"].alias("start"), F.array_join(cut(x), " ").alias("matched"),
        x["common"].alias("common"), x["unit"].alias("unit_bigrams"), F.get(size, x["no"]).alias("template_bigrams"), (x["common"] * 2.0 / total(x)).alias("dice"))


def oracle(templates: dict[str, str] | None = None, min_percent: int = MIN_PERCENT) -> str:
    """The same scan in DuckDB SQL, without the size bounds."""
    named = template_words(templates or TEMPLATES)
    anchors = ", ".join(f"'{w}'" for w in anchor_words({k: " ".join(w) for k, w in named.items()}, min_percent))
    quoted = ", ".join(f"('{k}', '{' '.join(w)}')" for k, w in named.items())
    pairs = "list_distinct(list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1]))"
    return f"""
WITH t AS (SELECT license_id, string_split(template, ' ') AS w FROM (VALUES {quoted}) v(license_id, template)),
ta AS (SELECT * FROM (SELECT license_id, len(w) AS m, {pairs.format(w='w')} AS grams, unnest(w) AS word, unnest(range(len(w))) AS o FROM t) WHERE word IN ({anchors})),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-z0-9]+') AS w FROM documents WHERE text IS NOT NULL),
p AS (SELECT * FROM (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS p FROM d) WHERE word IN ({anchors})),
c AS (SELECT DISTINCT r, license_id, m, grams, p - o AS start FROM p JOIN ta USING (word) WHERE p - o > -m),
x AS (SELECT r, doc_id, license_id, m, grams, start, w[greatest(start, 0) + 1:start + m] AS x FROM c JOIN d USING (r)),
b AS (SELECT *, {pairs.format(w='x')} AS g FROM x),
h AS (SELECT *, CAST(len(list_intersect(g, grams)) AS INTEGER) AS common, CAST(len(g) AS INTEGER) AS unit_bigrams, CAST(len(grams) AS INTEGER) AS template_bigrams FROM b),
k AS (SELECT *, common * 2.0::DOUBLE / (unit_bigrams + template_bigrams) AS dice FROM h WHERE len(g) > 0 AND common * 200 >= (unit_bigrams + template_bigrams) * {min_percent})
SELECT doc_id, license_id, CAST(start AS INTEGER) AS start, array_to_string(x, ' ') AS matched, common, unit_bigrams, template_bigrams, dice FROM k
WHERE NOT EXISTS (SELECT 1 FROM k y WHERE y.r = k.r AND y.license_id = k.license_id AND abs(y.start - k.start) < k.m AND
  (y.common * (k.unit_bigrams + k.template_bigrams) > k.common * (y.unit_bigrams + y.template_bigrams)
   OR y.common * (k.unit_bigrams + k.template_bigrams) = k.common * (y.unit_bigrams + y.template_bigrams) AND y.start < k.start))
"""
