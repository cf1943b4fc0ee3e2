"""Licence scan by a positional index of rare words.

The index: of each template of licence wording its ``RARE`` words of highest inverse document frequency (over the
templates) with all their positions.  A word finds its postings through a hash table in which every indexed word has
a slot of its own, so a lookup costs the same however many templates there are.

Each file's indexed words (its licence words of highest IDF) are looked up; each hit votes for the place where the
template would start, word position less template position.  Places are taken in two overlapping rows of windows of
``SLACK`` words, so a few words put in or left out do no harm.  A template is found in a window with at least
``SHARE`` of its postings, if its mandatory phrase stands there, word for word and at its own place.

Four short phrases are reported at all their places beside this.  All work is row by row in expressions: no shuffle,
and nothing but the index leaves the driver.

Defined results: null text is empty: no words, no labels, score 0; repeated rows give repeated rows; null doc_id is
carried; an empty table gives an empty table; other columns are ignored.  Of several windows of one template the one
with most votes is reported, the first of equals.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RARE, SHARE, SLACK = 12, 0.6, 16
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Fixed phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Label, wording, mandatory phrase.
TEMPLATES = [
    ("cc-by-nc", "licensed under CC BY-NC 4.0", "cc by nc"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0", "cc by sa"),
    ("cc-by-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License", "creative commons attribution"),
    ("gpl-notice", "this work is licensed under the GNU General Public License version", "licensed under the gnu general public license"),
    ("apache-notice", "licensed under the Apache License version 2.0", "licensed under the apache license"),
    ("mit-release", "released under the MIT License", "released under the mit license"),
    (
        "mit-grant",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"),
        to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
        and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so""",
        "permission is hereby granted free of charge",
    ),
    (
        "mit-terms",
        """The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
        PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
        WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE""",
        "all copies or substantial portions of the software",
    ),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary
        form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
        provided with the distribution""",
        "redistribution and use in source and binary forms",
    ),
    (
        "bsd-3",
        """the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission""",
        "endorse or promote products derived from this software",
    ),
    (
        "bsd-disclaimer",
        """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE
        LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
        GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY""",
        "incidental special exemplary or consequential damages",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above
        copyright notice and this permission notice appear in all copies""",
        "with or without fee is hereby granted",
    ),
    (
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the
        use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
        redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote
        the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
        Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software""",
        "the origin of this software must not be misrepresented",
    ),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this
        software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means""",
        "free and unencumbered software",
    ),
    (
        "boost",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by
        this license to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software""",
        "accompanying documentation covered by this license",
    ),
    (
        "apache-header",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of
        the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the
        License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License""",
        "you may not use this file except in compliance with the license",
    ),
    (
        "gpl-header",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free
        Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be
        useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
        License for more details. You should have received a copy of the GNU General Public License along with this program""",
        "published by the free software foundation",
    ),
    (
        "lgpl-header",
        """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the
        Free Software Foundation""",
        "gnu lesser general public license",
    ),
    (
        "agpl-header",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the
        Free Software Foundation""",
        "gnu affero general public license",
    ),
    (
        "mpl",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can
        obtain one at""",
        "mozilla public license",
    ),
    ("eupl", "Licensed under the European Union Public Licence EUPL", "european union public licence"),
]


def words_of(text: str) -> list[str]:
    """The words of a text, as ``scan`` splits them."""
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(UPPER, LOWER))) if w]


def index(templates: list[tuple[str, str, str]] | None = None) -> dict:
    """Words, their postings (template number, position), and per template: label, postings, votes needed, phrase and its place."""
    templates = templates or TEMPLATES
    texts = [words_of(t) for _, t, _ in templates]
    df: dict[str, int] = {}
    for t in texts:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    postings: dict[str, list[tuple[int, int]]] = {}
    kinds = []
    for k, ((label, _, phrase), t) in enumerate(zip(templates, texts, strict=True)):
        rare = sorted(set(t), key=lambda w: (-math.log(len(texts) / df[w]), w))[:RARE]
        own = [(w, i) for i, w in enumerate(t) if w in rare]
        for w, i in own:
            postings.setdefault(w, []).append((k, i))
        need = phrase.split()
        at = next(i for i in range(len(t)) if t[i : i + len(need)] == need)
        kinds.append({"label": label, "postings": len(own), "need": math.ceil(SHARE * len(own)), "phrase": need, "at": at})
    return {"words": sorted(postings), "postings": postings, "templates": kinds}


def slots(words: list[str]) -> tuple[int, int, list[int]]:
    """(shift, size, table): bits of a word's hash from ``shift`` up, modulo ``size``, give the number of the word; -1 elsewhere."""
    from xxhash import xxh64_intdigest

    hashes = [xxh64_intdigest(w.encode(), 42) for w in words]
    size = 1 << max(8, (4 * len(words)).bit_length())
    while True:
        for shift in range(0, 40):
            at = [h >> shift & size - 1 for h in hashes]
            if len(set(at)) == len(at):
                table = [-1] * size
                for k, x in enumerate(at):
                    table[x] = k
                return shift, size, table
        size *= 2


def _numbers(xs: list[int]) -> Column:
    """A literal array: one string that the optimizer splits once."""
    return F.split(F.lit(",".join(map(str, xs))), ",").cast("array<int>")


def _at(words: Column, i: Column, phrase: list[str]) -> Column:
    test = F.get(words, i) == phrase[0]
    for k, w in enumerate(phrase[1:], 1):
        test = test & (F.get(words, i + k) == w)
    return F.coalesce(test, F.lit(False))


def _places(words: Column, phrase: list[str]) -> Column:
    every = F.sequence(F.lit(0), F.size(words) - len(phrase))
    return F.when((F.size(words) >= len(phrase)) & F.array_contains(words, phrase[0]), F.filter(every, lambda i: _at(words, i, phrase))).otherwise(F.array().cast("array<int>"))


def _lookup(entry: dict):
    """(number of the slot's word, whether that is the word itself) of a word."""
    shift, size, table = slots(entry["words"])
    slot, known = _numbers(table), F.split(F.lit(",".join(entry["words"])), ",")
    number = lambda w: F.get(slot, F.shiftrightunsigned(F.xxhash64(w), shift).bitwiseAND(F.lit(size - 1)).cast("int"))
    return number, lambda w: F.get(known, number(w)) == w


def _hits(words: Column, entry: dict) -> Column:
    """Places of the indexed words of a text: an array of (k, i), k the number of the word."""
    number, is_known = _lookup(entry)
    marked = F.transform(words, lambda w, i: F.when(is_known(w), F.struct(number(w).alias("k"), i.alias("i"))))
    return F.filter(marked, lambda x: x.isNotNull())


def _least_distinct(entry: dict) -> int:
    """So many different indexed words a text must have for any template to get its votes."""
    least = []
    for t, e in enumerate(entry["templates"]):
        votes = sorted((sum(k == t for k, _ in own) for own in entry["postings"].values()), reverse=True)
        n, total = 0, 0
        while total < e["need"]:
            total += votes[n]
            n += 1
        least.append(n)
    return min(least)


def _windows(hits: Column, entry: dict) -> Column:
    """(t, o, b) of each vote, in order: template, row of windows, window."""
    posts = [[t << 16 | p for t, p in entry["postings"][w]] for w in entry["words"]]
    flat, start = _numbers([x for p in posts for x in p]), _numbers([sum(map(len, posts[:k])) + 1 for k in range(len(posts))])
    count = _numbers([len(p) for p in posts])
    own = lambda x: F.slice(flat, F.get(start, x.k), F.get(count, x.k))
    window = lambda x, c, o: F.struct(
        F.shiftright(c, 16).alias("t"), F.lit(o).alias("o"), F.floor((x.i - c.bitwiseAND(F.lit(0xFFFF)) + o * (SLACK // 2)) / SLACK).cast("int").alias("b")
    )
    votes = F.flatten(F.transform(hits, lambda x: F.flatten(F.transform(own(x), lambda c: F.array(window(x, c, 0), window(x, c, 1))))))
    return F.array_sort(votes)


def _verified(words: Column, votes: Column, entry: dict) -> Column:
    """(t, share, at) of each window with enough votes and the phrase at its place; ``at`` is where the template starts."""
    kinds = entry["templates"]
    need, of, place = (_numbers([e[c] for e in kinds]) for c in ("need", "postings", "at"))
    length, phrase = _numbers([len(e["phrase"]) for e in kinds]), F.split(F.lit(",".join(" ".join(e["phrase"]) for e in kinds)), ",")
    # equal votes are neighbours: a window has enough if the vote ``need`` places on is the same
    enough = F.filter(votes, lambda x, i: ~F.coalesce(F.get(votes, i - 1) == x, F.lit(False)) & F.coalesce(F.get(votes, i + F.get(need, x.t) - 1) == x, F.lit(False)))
    stands = lambda x, s: (s + F.get(place, x.t) >= 0) & (F.array_join(F.slice(words, F.greatest(s + F.get(place, x.t), F.lit(0)) + 1, F.get(length, x.t)), " ") == F.get(phrase, x.t))
    first = lambda x: x.b * SLACK - x.o * (SLACK // 2)
    starts = lambda x: F.filter(F.sequence(first(x), first(x) + SLACK - 1), lambda s: stands(x, s))
    share = lambda x: F.least(F.lit(1.0), F.size(F.filter(votes, lambda y: y == x)) / F.get(of, x.t))
    marked = F.transform(enough, lambda x: F.struct(x.t.alias("t"), share(x).alias("share"), F.get(starts(x), F.lit(0)).alias("at")))
    return F.filter(marked, lambda x: x["at"].isNotNull())


def scan(docs: DataFrame, templates: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of every document.

    ``templates`` (label, wording, phrase of the wording; less than 65,536 words each) may replace the given ones.  spans: label and first word of
    each template found.
    """
    entry = index(templates)
    low = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.array_remove(F.split(low, SEPARATORS), "").alias("words"))
    words = F.col("words")
    heads = F.array(*[F.lit(w) for w in dict.fromkeys(p.split()[0] for p in PHRASES)])
    known = F.filter(F.array_distinct("words"), _lookup(entry)[1])
    out = out.withColumns({"enough": F.size(known) >= _least_distinct(entry), "hint": F.arrays_overlap("words", heads)})
    out = out.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.when(F.col("hint") | F.col("enough"), words).otherwise(F.array().cast("array<string>")).alias("words"),
        F.when(F.col("enough"), _hits(words, entry)).otherwise(F.array().cast("array<struct<k:int,i:int>>")).alias("hits"),
    )
    base = [(label, _places(words, phrase.split())) for phrase, label in PHRASES.items()]
    out = out.withColumn("votes", _windows(F.col("hits"), entry)).withColumn("found", _verified(words, F.col("votes"), entry))
    labels = F.split(F.lit(",".join(e["label"] for e in entry["templates"])), ",")
    best = F.array_sort(F.transform("found", lambda f: F.struct(f.t.alias("t"), (-f.share).alias("less"), f["at"].alias("at"))))
    out = out.select("doc_id", "n_words", F.array(*[F.struct(F.lit(label).alias("label"), at.alias("at")) for label, at in base]).alias("base"), best.alias("best"))
    # the first of each template in that order is its best window
    one = F.filter("best", lambda x, i: ~F.coalesce(F.get(F.col("best"), i - 1).t == x.t, F.lit(False)))
    spans = F.transform(one, lambda x: F.struct(F.get(labels, x.t).alias("label"), x["at"].alias("first_word"), (-x.less).alias("share")))
    out = out.select("doc_id", "n_words", "base", F.flatten(F.transform("base", lambda b: b["at"])).alias("places"), spans.alias("spans"))
    base_labels = F.transform(F.filter("base", lambda b: F.size(b["at"]) > 0), lambda b: b.label)
    return out.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, F.transform("spans", lambda s: s.label)))), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("spans", lambda s: s.share)), F.lit(0.0))).alias("score"),
        "spans",
    )
