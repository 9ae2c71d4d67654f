"""Licence scan: sparse TF-IDF cosine of headers and licence files to templates, then inheritance from the nearest directory above.

What is compared with a template is a unit of a text: each line, each block of two lines or more with words, which lines without a
word set apart (a header, a paragraph), and, in a licence file, the whole text. Words are weighted by their number in the unit and by
their rarity over all documents; words that no template uses count as the rarest, so prose that happens to hold a template's words
stays far from it. A unit is a notice of the template with the largest cosine if that is at least :data:`THRESHOLD`. It must hold
those words of the licence's name that the template holds: without them it may be a notice of another licence in like words. A
document's own licence is that of its best unit. ``line`` is the unit's first line.

Only units that hold an anchor word are compared. The anchors of a template are its rarest words, as many as it takes for the rest to
be unable to reach the threshold by themselves, so no notice is missed. The words of such units are counted, and their products with
the templates added up, as rows by unit and template: the work grows with the words, however long a line is.

A document is a file at a path. A licence file (named by :data:`LICENCE_FILE`) speaks for its directory and those below it: a file
without a notice of its own takes the licence of the nearest one. Directories, not files, are joined to their ancestors.

Everything is built from Spark's own functions; the templates are the only constants, and their words' frequencies the only thing
that comes to the driver. Only their table, of one row for each word of a template, is broadcast.

Defined results: a null or empty text has no licence of its own and may inherit one; a null path is in no directory; among units of
equal cosine that with the first line wins, among templates the first by name, among licence files of one directory the best cosine,
then the name; repeated rows are two files.
"""

from __future__ import annotations

import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mallflow.llm.frames import fresh, let, stored

THRESHOLD = 0.6
LICENCE_FILE = "(?i)^(?:licen[cs]e|copying)(?:\\..*)?$"

# Names of licences, their titles, and the notices and paragraphs by which files refer to them or state them.
_MIT = [
    "MIT License",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
    "so, subject to the following conditions:",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
    "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
    "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
]
_BSD = [
    "BSD 3-Clause License",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met:",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
    "the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission.",
]
_APACHE = [
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language '
    "governing permissions and limitations under the License.",
]
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} General Public License as "
    "published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)
TEMPLATES = [
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", _GNU.format("Affero", 3)),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    *[("Apache-2.0", part) for part in _APACHE],
    ("Apache-2.0", " ".join(_APACHE)),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license"),
    *[("BSD-3-Clause", part) for part in _BSD],
    ("BSD-3-Clause", " ".join(_BSD)),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", _GNU.format("", 2)),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", _GNU.format("", 3)),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", _GNU.format("Lesser", 3)),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    *[("MIT", part) for part in _MIT],
    ("MIT", " ".join(_MIT)),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
]
TEMPLATES += [(name, f"SPDX-License-Identifier: {name}") for name in dict.fromkeys(name for name, _ in TEMPLATES)]

_SEPARATORS = "[^\\p{L}\\p{N}]+"
# By word: its rarity, its weight by template over the template's norm, and whether it is part of the licence's name there.
_USES = "array<struct<template:int,weight:double,named:int>>"
_MODEL = f"array<struct<word:string,idf:double,uses:{_USES}>>"
_WHOLE = -1


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SEPARATORS), lambda w: w != "")


def _template_words(spark) -> list[tuple[str, list[str]]]:
    each = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(notice).alias("notice")) for name, notice in TEMPLATES])
    rows = spark.range(1).select(F.inline(each)).select("name", _words(F.col("notice")).alias("words"))
    return [(row["name"], row["words"]) for row in rows.collect()]


def _strings(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def rarity(docs: DataFrame, words: list[str]) -> tuple[dict[str, float], float]:
    """Inverse document frequency of the given words over all documents, and that of a word in none of them."""
    total = docs.count()
    met = docs.select(F.explode(F.array_intersect(_words(F.col("text")), _strings(words))).alias("word"))
    rows = {row["word"]: row["n"] for row in met.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: math.log((1 + total) / (1 + rows.get(w, 0))) + 1 for w in words}, math.log(1 + total) + 1


def _anchors(weights: dict[str, float], idf: dict[str, float]) -> set[str]:
    """The rarest words of a template without which no unit reaches the threshold."""
    rest = sum(w * w for w in weights.values())
    whole, taken = rest, set()
    for word in sorted(weights, key=lambda w: (-idf[w], -weights[w], w)):
        if math.sqrt(max(rest, 0.0) / whole) < THRESHOLD:
            break
        taken.add(word)
        rest -= weights[word] ** 2
    return taken


def _units(text: Column, licence_file: Column, anchors: Column) -> Column:
    """Array of (line, words, whole) of a text's lines, blocks and, of a licence file, all of it, if they hold an anchor word."""
    kind = "array<struct<line:int,words:array<string>,whole:boolean>>"

    def unit(line: Column, words: Column, whole: bool = False) -> Column:
        return F.struct(line.cast("int").alias("line"), words.alias("words"), F.lit(whole).alias("whole"))

    def blocks(lines: Column, edges: Column) -> Column:
        between = F.transform(
            F.sequence(F.lit(0), F.size(edges) - 2),
            lambda i: F.struct((F.get(edges, i) + 1).alias("line"), (F.get(edges, i + 1) - F.get(edges, i) - 1).alias("n")),
        )
        return F.transform(
            F.filter(between, lambda b: b["n"] > 1), lambda b: unit(b["line"], F.flatten(F.slice(lines, b["line"] + 1, b["n"])))
        )

    def every(lines: Column) -> Column:
        empty = F.filter(F.transform(lines, lambda words, at: F.when(F.size(words) == 0, at)), lambda at: at.isNotNull())
        edges = F.concat(F.array(F.lit(-1)), empty, F.array(F.size(lines)))
        whole = F.when(licence_file, F.array(unit(F.lit(0), F.flatten(lines), True))).otherwise(F.array().cast(kind))
        return F.concat(F.transform(lines, lambda words, at: unit(at, words)), let(edges, lambda edges: blocks(lines, edges)), whole)

    lines = F.transform(F.split(text, "\n"), _words)
    return F.filter(let(lines, every), lambda x: F.arrays_overlap(x["words"], anchors))


def _name_words(name: str) -> set[str]:
    return set(name.lower().replace(".", "-").split("-"))


def _model(docs: DataFrame) -> tuple[DataFrame, float, list[str], list[int]]:
    """The templates by word (word, idf, uses), the rarity of all other words, the anchors, and by template the number of words that are
    part of the licence's name."""
    spark = docs.sparkSession
    templates = _template_words(spark)
    vocabulary = sorted({w for _, words in templates for w in words})
    idf, unseen = rarity(docs, vocabulary)
    uses: dict[str, list[dict]] = {w: [] for w in vocabulary}
    anchors: set[str] = set()
    for number, (name, words) in enumerate(templates):
        weights = {w: n * idf[w] for w, n in Counter(words).items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        for word, weight in weights.items():
            uses[word].append({"template": number, "weight": weight / norm, "named": int(word in _name_words(name))})
        anchors |= _anchors(weights, idf)
    rows = [{"word": w, "idf": idf[w], "uses": uses[w]} for w in vocabulary]
    table = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), _MODEL)))
    return table, unseen, sorted(anchors), [len(set(words) & _name_words(name)) for name, words in templates]


def _best(units: DataFrame, table: DataFrame, unseen: float, named: list[int]) -> DataFrame:
    """The best notice ``own`` (score, line, name) of each ``row`` of ``units`` (row, line, words, whole)."""
    unit = ["row", "whole", "line", "last"]
    words = units.select("row", "whole", "line", F.size("words").alias("last"), F.explode("words").alias("word"))
    counted = words.groupBy(*unit, "word").agg(F.count(F.lit(1)).alias("n"))
    known = counted.join(F.broadcast(table), "word", "left")
    weight = F.col("n") * F.coalesce("idf", F.lit(unseen))
    own = F.struct(F.lit(_WHOLE).alias("template"), (weight * weight).alias("part"), F.lit(0).alias("named"))
    products = F.transform(
        F.coalesce("uses", F.array().cast(_USES)),
        lambda u: F.struct(u["template"].alias("template"), (u["weight"] * weight).alias("part"), u["named"].alias("named")),
    )
    parts = known.select(*unit, F.inline(F.concat(F.array(own), products)))
    sums = parts.groupBy(*unit, "template").agg(F.sum("part").alias("part"), F.sum("named").alias("named"))
    norm = F.sqrt(F.max(F.when(F.col("template") == _WHOLE, F.col("part"))))
    scores = sums.groupBy(*unit).agg(
        norm.alias("norm"), F.collect_list(F.when(F.col("template") != _WHOLE, F.struct("template", "part", "named"))).alias("dots")
    )
    names = F.array(*[F.lit(name) for name, _ in TEMPLATES])
    needed = F.get(F.array(*[F.lit(n) for n in named]), F.col("template"))
    each = scores.select("row", "line", "norm", F.inline("dots")).where(F.col("named") == needed)
    cosine = F.round(F.col("part") / F.col("norm"), 9)
    each = each.select("row", F.struct((-cosine).alias("minus"), "line", F.get(names, F.col("template")).alias("name")).alias("x"))
    least = each.where(F.col("x.minus") <= -THRESHOLD).groupBy("row").agg(F.min("x").alias("x"))
    return least.select("row", F.struct((-F.col("x.minus")).alias("score"), F.col("x.line").alias("line"), F.col("x.name").alias("name")).alias("own"))


def own_licences(docs: DataFrame, into: str = "own", file: str | None = None) -> DataFrame:
    """``docs`` without its text, with a struct ``into`` (score, line, name) of each text's best notice, null without one. ``file`` is the
    column of file names by which licence files are known."""
    keep = [c for c in docs.columns if c != "text"]
    row, units = fresh(docs.columns, "row"), fresh(docs.columns, "units")
    table, unseen, anchors, named = _model(docs)
    anchor_words = _strings(anchors)
    licence_file = F.coalesce(F.col(file).rlike(LICENCE_FILE), F.lit(False)) if file else F.lit(False)
    found = F.when(F.arrays_overlap(_words(F.col("text")), anchor_words), _units(F.col("text"), licence_file, anchor_words))
    rows = stored(docs.select(*keep, F.monotonically_increasing_id().alias(row), found.alias(units)), "units")
    some = rows.where(F.size(units) > 0).select(F.col(row).alias("row"), F.inline(units))
    best = stored(_best(some, table, unseen, named), "own-licences", narrow=True).select(F.col("row").alias(row), F.col("own").alias(into))
    return rows.drop(units).join(best, row, "left").select(*keep, into)


def _directory(path: str) -> Column:
    """Everything before the last slash; empty for a file at the top."""
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.substr(path, F.lit(1), F.lit(0)))


def _above(directory: str) -> Column:
    """The directory and all those above it, the top (empty) first, with their depth."""
    parts = F.filter(F.split(directory, "/"), lambda p: p != "")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("above"))
    )


def inherited(files: DataFrame) -> DataFrame:
    """For each directory of ``files`` (directory, file, own): the licence of the nearest directory at or above it that has one."""
    speak = files.where(F.col("file").rlike(LICENCE_FILE) & F.col("own").isNotNull() & F.col("directory").isNotNull())
    # The best cosine first, then the first name: the least of (minus score, name).
    best = F.min(F.struct((-F.col("own.score")).alias("minus"), F.col("own.name").alias("name")))
    parts = F.filter(F.split("directory", "/"), lambda p: p != "")
    given = stored(speak.withColumn("above", F.array_join(parts, "/")).groupBy("above").agg(best.alias("best")), "licence-directories")
    every = files.where("directory is not null").select("directory").distinct()
    chains = every.select("directory", F.inline(_above("directory")))
    nearest = chains.join(given, "above").groupBy("directory").agg(F.max(F.struct("depth", "above", F.col("best.name").alias("name"))).alias("nearest"))
    return nearest.select("directory", F.col("nearest.above").alias("from"), F.col("nearest.name").alias("name"))


def scan_licences(docs: DataFrame, path: str = "path") -> DataFrame:
    """``docs`` without its text, with ``own`` (score, line, name), ``inherited`` (name, from) and ``licence``: its own, else the
    inherited one. New columns get underscores where names clash."""
    keep = [c for c in docs.columns if c != "text"]
    own, directory, file = (fresh(docs.columns, name) for name in ("own", "directory", "file"))
    named = docs.withColumns({directory: _directory(path), file: F.regexp_extract(path, "([^/]*)$", 1)})
    named = own_licences(named, own, file)
    rows = stored(named, "notices")
    files = rows.select(F.col(directory).alias("directory"), F.col(file).alias("file"), F.col(own).alias("own"))
    below, given = (fresh(rows.columns, name) for name in ("below", "given"))
    nearest = stored(inherited(files), "inherited").select(
        F.col("directory").alias(below), F.struct("name", "from").alias(given)
    )
    joined = rows.join(nearest, F.col(directory) == F.col(below), "left")
    got, licence = fresh(docs.columns, "inherited"), fresh(docs.columns, "licence")
    whose = F.when(F.col(own).isNull(), F.col(given))
    return joined.select(*keep, own, whose.alias(got), F.coalesce(F.col(f"{own}.name"), whose["name"]).alias(licence))


def with_paths(docs: DataFrame) -> DataFrame:
    """``docs`` with a ``path``: directories by source, thousand and hundred of the doc_id. Every fiftieth file is a licence file; one
    that begins a thousand lies a directory higher."""
    number = F.coalesce("doc_id", F.lit(-1))
    top = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.floor(number / 1000).cast("string"))
    below = F.concat_ws("/", top, F.floor(number / 100).cast("string"))
    place = F.when(number % 1000 == 0, F.concat(top, F.lit("/LICENSE"))).when(number % 50 == 0, F.concat(below, F.lit("/LICENSE")))
    return docs.withColumn("path", F.coalesce(place, F.concat(below, F.lit("/"), number.cast("string"), F.lit(".txt"))))
