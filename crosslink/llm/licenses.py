"""Licence scan by a positional index of rare licence words; DataFrame functions only.

The index is the templates' words with their places. A template is looked at if a file has all words of its mandatory phrases. Of its
words that stand in the file, those of the highest inverse document frequency are looked up: each place in the file and each
place in the template give a relative position, and places that agree on it are counted together. Where enough meet, the
template's mandatory phrases must stand at their places in the file.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases of the plain search and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Label, text of the licence or of its usual notice, phrases that must stand in it. Short ones are usual lines.
TEMPLATES = [
    (
        "agpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
        This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.
        You should have received a copy of the GNU Affero General Public License along with this program.""",
        ["terms of the gnu affero general public license", "free software foundation"],
    ),
    (
        "apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
        You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License.""",
        ["apache license version 2 0", "in compliance with the license"],
    ),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ["apache license version 2 0"]),
    (
        "bsd-2-clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
        the following disclaimer in the documentation and/or other materials provided with the distribution.""",
        ["source and binary forms", "redistributions in binary form must reproduce"],
    ),
    (
        "bsd-3-clause",
        """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
        this software without specific prior written permission.
        THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
        LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
        ["endorse or promote products derived from this software"],
    ),
    (
        "bsl-1.0",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying
        documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to
        prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the
        following:""",
        ["accompanying documentation covered by this license"],
    ),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", ["creative commons attribution 4 0"]),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ["cc by nc 4 0"]),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ["cc by sa 4 0"]),
    (
        "gpl",
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.
        This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
        You should have received a copy of the GNU General Public License along with this program.""",
        ["terms of the gnu general public license", "free software foundation"],
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License version 3", ["gnu general public license version 3"]),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
        the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
        DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
        ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
        ["with or without fee is hereby granted"],
    ),
    (
        "lgpl",
        """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as
        published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.
        This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.""",
        ["terms of the gnu lesser general public license"],
    ),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
        "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to
        the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
        CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
        SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
        ["permission is hereby granted free of charge", "associated documentation files"],
    ),
    ("mit", "Released under the MIT License", ["the mit license"]),
    (
        "mpl-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this
        file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
        ["mozilla public license v 2 0"],
    ),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain.
        Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any means.
        In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the
        software to the public domain.""",
        ["free and unencumbered software"],
    ),
    (
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages
        arising from the use of this software.
        Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute
        it freely, subject to the following restrictions:""",
        ["provided as is without any express or implied warranty", "redistribute it freely"],
    ),
]
#: So many words of a template are looked up in a file, and such a share of their places must meet.
ANCHORS = 8
SHARE = 0.6
TURN = 1 << 32
SHIFT = 1000


def words_of_template(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())


def place_of(words: list[str], phrase: list[str]) -> int:
    return next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)


WORDS = [words_of_template(text) for _, text, _ in TEMPLATES]
VOCABULARY = sorted({w for words in WORDS for w in words})


def with_words(docs: DataFrame) -> DataFrame:
    """``docs`` with __words, an array, empty for a null text; an empty table gives none. ASCII words come out in lower case; the one sign whose lower case is ASCII is kept apart."""
    plain = F.lower(F.replace(F.coalesce("text", F.lit("")), F.lit("K"), F.lit("ĸ")))
    return docs.withColumn("__words", F.filter(F.split(plain, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != ""))


def strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def word_counts(docs: DataFrame) -> dict[str, int]:
    """In how many of all documents each template word stands; 0 for all of an empty table."""
    found = with_words(docs.select("text")).select(F.explode(F.array_intersect("__words", strings(VOCABULARY))).alias("word"))
    counts = {r["word"]: r["count"] for r in found.groupBy("word").count().collect()}  # one row for each template word
    return {w: counts.get(w, 0) for w in VOCABULARY}


def by_rarity(counts: dict[str, int]) -> list[list[str]]:
    """Of each template its words, those of highest inverse document frequency (fewest documents) first; ties in order of the alphabet."""
    return [sorted(set(words), key=lambda w: (counts.get(w, 0), w)) for words in WORDS]


def listed(lists: list[list[str]]) -> Column:
    """An array of arrays of words."""
    return F.array(*[F.split(F.lit(" ".join(words)), " ") for words in lists])


def scan(docs: DataFrame, rarity: list[list[str]] | None = None) -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels and score.

    n_base counts the places where a phrase's words stand one after another, first_word and last_word are the least and
    largest start of such a place (null without any). labels adds the templates that are found to base_labels; both are
    distinct, sorted and joined by commas, empty without any. score: the largest share of a found template's places that meet, at
    least 0.5 where a phrase stands, else 0. Null texts count as empty. Rows are independent; columns of these names are
    replaced. An empty table gives no rows. ``rarity``: the templates' words in the order in which they are looked up.
    """
    rarity = rarity or by_rarity(word_counts(docs))
    out = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    own = [c for c in docs.columns if c not in out]
    # the caller's columns are numbered here, so that no name of theirs meets one of these steps
    df = with_words(docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)], F.col("text").alias("text")))

    # plain search: each word stands as " word ", so places can't overlap and two blanks are one word
    df = df.withColumn("__text", F.when(F.arrays_overlap("__words", strings(["license", "cc"])), F.concat(F.lit(" "), F.array_join("__words", "  "), F.lit(" "))))
    spaced = {p: " " + p.replace(" ", "  ") + " " for p in PHRASES}
    count = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    places = [
        F.when(
            F.contains("__text", F.lit(s)),
            F.struct(
                (F.size(F.split("__text", s)) - 1).cast("long").alias("n"),
                (count(F.substring_index("__text", s, 1)) / 2).cast("long").alias("first"),
                (F.size("__words") - count(F.substring_index("__text", s, -1)) / 2 - len(p.split())).cast("long").alias("last"),
                F.lit(PHRASES[p]).alias("label"),
            ),
        )
        for p, s in spaced.items()
    ]
    df = df.withColumn("__places", F.array_compact(F.array(*places)))

    # templates whose phrases can stand in the file, each with the file's own rarest words of it
    df = df.withColumn("__there", F.array_intersect("__words", strings(VOCABULARY)))
    keys = listed([sorted({w for k in phrases for w in k.split()}) for _, _, phrases in TEMPLATES])
    places_of, ordered = listed(WORDS), listed(rarity)
    every = F.sequence(F.lit(0), F.lit(len(TEMPLATES) - 1))
    may = F.filter(every, lambda t: F.size(F.array_except(F.get(keys, t), F.col("__there"))) == 0)
    df = df.withColumn("__may", F.transform(may, lambda t: F.struct(t.alias("t"), F.slice(F.array_intersect(F.get(ordered, t), F.col("__there")), 1, ANCHORS).alias("anchors"))))
    # postings of a template: the places of each of these words
    standing = lambda c: F.transform(c["anchors"], lambda a: F.array_compact(F.transform(F.get(places_of, c["t"]), lambda w, p: F.when(w == a, p))))
    df = df.withColumn("__may", F.transform("__may", lambda c: F.struct(c["t"].alias("t"), c["anchors"].alias("anchors"), standing(c).alias("postings"))))
    size = lambda c: F.size(F.flatten(c["postings"]))
    df = df.withColumn("__may", F.transform("__may", lambda c: F.struct(c["t"].alias("t"), c["anchors"].alias("anchors"), c["postings"].alias("postings"), size(c).alias("size"))))

    # each place of such a word in the file against the postings of the word: template and relative position in one number
    looked_up = F.array_distinct(F.flatten(F.transform("__may", lambda c: c["anchors"])))
    df = df.withColumn("__looked", F.when(F.size("__may") > 0, looked_up))
    numbered = F.filter(F.transform("__words", lambda w, i: F.struct(w.alias("w"), i.cast("long").alias("i"))), lambda x: F.array_contains("__looked", x["w"]))
    df = df.withColumn("__at", F.when(F.size("__may") > 0, numbered))

    def codes_of(c: Column) -> Column:
        posted = lambda x: F.get(c["postings"], F.array_position(c["anchors"], x["w"]).cast("int") - 1)
        return F.flatten(F.transform(F.filter("__at", lambda x: F.array_contains(c["anchors"], x["w"])), lambda x: F.transform(posted(x), lambda p: c["t"].cast("long") * TURN + SHIFT + x["i"] - p)))

    template = lambda code: F.shiftright(code, 32).cast("int")
    df = df.withColumn("__codes", F.when(F.size("__may") > 0, F.array_sort(F.flatten(F.transform("__may", codes_of)))))
    size_of = lambda code: F.get(F.filter("__may", lambda c: c["t"] == template(code)), F.lit(0))["size"]
    # equal codes stand together: where each run begins, and its length from there to the next one
    code = lambda i: F.get("__codes", i.cast("int"))
    begins = F.filter(F.sequence(F.lit(0), F.size("__codes") - 1), lambda i: (i == 0) | (code(i) != code(i - 1)))
    df = df.withColumn("__begins", F.when(F.size("__codes") > 0, begins))
    length = lambda i, k: (F.coalesce(F.get("__begins", k + 1), F.size("__codes")) - i).cast("int")
    runs = F.transform("__begins", lambda i, k: F.struct(code(i).alias("code"), length(i, k).alias("n")))
    df = df.withColumn("__runs", F.filter(runs, lambda r: r["n"] >= F.ceil(size_of(r["code"]) * SHARE)))

    # mandatory phrases at their places
    phrases = [F.array(*[F.struct(F.lit(place_of(words, k.split())).alias("at"), F.lit(len(k.split())).alias("n"), F.lit(k).alias("text")) for k in must]) for words, (_, _, must) in zip(WORDS, TEMPLATES)]
    start = lambda code: (code.bitwiseAND(F.lit(TURN - 1)) - SHIFT).cast("int")
    holds = lambda code, k: F.when(start(code) + k["at"] >= 0, F.array_join(F.slice("__words", start(code) + k["at"] + 1, k["n"]), " ") == k["text"]).otherwise(False)
    sure = F.filter("__runs", lambda r: F.forall(F.element_at(F.array(*phrases), template(r["code"]) + 1), lambda k: holds(r["code"], k)))
    found = F.transform(sure, lambda r: F.struct(template(r["code"]).alias("t"), (r["n"] / size_of(r["code"])).alias("share")))
    df = df.withColumn("__sure", F.coalesce(found, F.array().cast("array<struct<t:int,share:double>>")))

    names = strings([t[0] for t in TEMPLATES])
    base = F.array_sort(F.array_distinct(F.transform("__places", lambda p: p["label"])))
    more = F.transform("__sure", lambda r: F.element_at(names, r["t"] + 1))
    best = F.array_max(F.transform("__sure", lambda r: r["share"]))
    return df.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(own)],
        F.size("__words").cast("long").alias("n_words"),
        F.aggregate("__places", F.lit(0).cast("long"), lambda a, p: a + p["n"]).alias("n_base"),
        F.array_min(F.transform("__places", lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform("__places", lambda p: p["last"])).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, more))), ",").alias("labels"),
        F.greatest(F.coalesce(best, F.lit(0.0)), F.when(F.size("__places") > 0, 0.5).otherwise(0.0)).alias("score"),
    )
