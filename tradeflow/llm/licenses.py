"""Licence notices and licence texts in documents, by the Dice coefficient over word bigrams."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Wording per licence, as it is published or commonly written: short notices, clauses, and texts without their
#: title and copyright line. Fixed values.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    ),
    "BSD-2-Clause": (
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    ),
    "BSD-3-Clause": (
        "Use of this source code is governed by a BSD-style license.",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    ),
    "CC-BY-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    ),
    "ISC": (
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.""",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "MIT": (
        "Released under the MIT License.",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction""",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR
IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    ),
}
LEAST_DICE = 0.8


def normalised(text: Column) -> Column:
    """Lower case; every run of characters other than letters and digits is one space; trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def bigrams(words: Column) -> Column:
    """The different pairs of neighbouring words; a single word has none."""
    joined = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.filter(joined, lambda pair: pair.isNotNull()))


def template_words(wording: str) -> list[str]:
    return re.sub(r"[\W_]+", " ", wording.lower()).split()


def anchors(pairs: Sequence[str], least: float) -> list[str]:
    """Bigrams of a template of which every set that reaches ``least`` holds one.

    Sets of m and n bigrams with c in common reach it only if ``c >= m * least / (2 - least)``, as n is c or
    more. So any choice of one bigram more than may be missing will do; those that begin with the longest words are
    taken: such words are rare, and only where one stands is a text looked at further.
    """
    fewest = math.ceil(len(pairs) * least / (2 - least) - 1e-9)
    return sorted(pairs, key=lambda p: (-p.index(" "), p))[: len(pairs) - fewest + 1]


def scan_licenses(
    docs: DataFrame, templates: Mapping[str, str | Sequence[str]] = TEMPLATES, least: float = LEAST_DICE
) -> DataFrame:
    """doc_id, licenses (names in order, joined by ``;``), best_license and best_dice of every row of ``docs``.

    Words are runs of letters and digits, so line breaks, comment marks and punctuation do not matter. A window of
    as many words as a template has is laid over the text wherever one of the template's anchors stands, so
    that the anchor lies in the window where it lies in the template (from the first word on, where the text starts
    later). Window and template are compared by twice the common word bigrams over the sum of both counts;
    those that reach ``least`` are hits. Windows too short for ``2 * min(m, n) >= least * (m + n)`` are left out before
    their bigrams are compared. A hit loses to one of another licence that overlaps it and has a higher coefficient (then:
    more words, then the name that sorts first). What stays gives the licences.

    Rows are scanned where they are: nothing is exploded or shuffled. The whole text is read, however long; hits of
    one text are compared with each other. A text that is null, empty or has no notice gives an empty text and
    nulls; equal rows are scanned each; an empty table gives no rows; no templates give no licences; other columns
    are not read.
    """
    wordings = [(name, w) for name, given in sorted(templates.items()) for w in ([given] if isinstance(given, str) else given)]
    known = [(name, words) for name, words in ((n, template_words(w)) for n, w in wordings) if len(words) > 1]
    if not known:
        none = F.lit(None)
        return docs.select("doc_id", F.lit("").alias("licenses"), none.cast("string").alias("best_license"), none.cast("double").alias("best_dice"))
    places, table = defaultdict(list), []
    for k, (name, words) in enumerate(known):
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
        chosen = set(anchors(list(dict.fromkeys(pairs)), least))
        for j, pair in enumerate(pairs):
            if pair in chosen:
                places[pair].append(F.struct(F.lit(k).alias("k"), F.lit(j).alias("j")))
        distinct = F.array(*[F.lit(p) for p in dict.fromkeys(pairs)])
        table.append(F.struct(F.lit(name).alias("name"), F.lit(-k).alias("rank"), F.lit(len(words)).alias("words"), distinct.alias("pairs")))
    template = lambda k: F.get(F.array(*table), k)
    first = sorted({pair.split(" ")[0] for pair in places})
    lookup = F.create_map(*[x for pair, found in sorted(places.items()) for x in (F.lit(pair), F.array(*found))])

    words = F.col("_words")
    spots = F.filter(F.transform(words, lambda w, i: F.when(w.isin(first), i)), lambda i: i.isNotNull())
    pair_at = lambda i: F.concat(F.get(words, i), F.lit(" "), F.get(words, i + 1))
    aligned = lambda i: F.transform(
        F.try_element_at(lookup, F.coalesce(pair_at(i), F.lit(""))),
        lambda a: F.struct(a["k"].alias("k"), F.greatest(F.lit(0), i - a["j"]).alias("at")),
    )
    starts = F.array_distinct(F.flatten(F.filter(F.transform("_spots", aligned), lambda a: a.isNotNull())))

    def window(s: Column) -> Column:
        return F.struct(s["k"].alias("k"), s["at"].alias("at"), bigrams(F.slice(words, s["at"] + 1, template(s["k"])["words"])).alias("set"))

    def score(w: Column) -> Column:
        t = template(w["k"])
        n, m = F.size(w["set"]), F.size(t["pairs"])
        fits = 2 * F.least(n, m) >= F.lit(least) * (n + m)
        return F.struct(
            F.when(fits, 2 * F.size(F.array_intersect(w["set"], t["pairs"])) / (n + m)).alias("dice"),
            t["words"].alias("words"),
            t["rank"].alias("rank"),
            t["name"].alias("name"),
            w["at"].alias("at"),
        )

    def loses(h: Column) -> Column:
        better = lambda g: F.struct(g["dice"], g["words"], g["rank"]) > F.struct(h["dice"], h["words"], h["rank"])
        overlaps = lambda g: (g["at"] < h["at"] + h["words"]) & (h["at"] < g["at"] + g["words"])
        return F.exists("_hits", lambda g: (g["name"] != h["name"]) & overlaps(g) & better(g))

    hits = F.filter(F.transform(F.transform("_starts", window), score), lambda h: h["dice"] >= least)
    best = F.array_max("_kept")
    return (
        docs.select("doc_id", F.split(normalised(F.coalesce("text", F.lit(""))), " ").alias("_words"))
        .select("doc_id", "_words", spots.alias("_spots"))
        .select("doc_id", "_words", starts.alias("_starts"))
        .select("doc_id", hits.alias("_hits"))
        .select("doc_id", F.filter("_hits", lambda h: ~loses(h)).alias("_kept"))
        .select(
            "doc_id",
            F.array_join(F.array_sort(F.array_distinct(F.transform("_kept", lambda h: h["name"]))), ";").alias("licenses"),
            best["name"].alias("best_license"),
            F.round(best["dice"], 6).alias("best_dice"),
        )
    )
