"""License scans: a trained classifier of paragraphs names the licence family, a template confirms it.

Paragraphs are lines. A notice may be a line, a sentence of it, or stand anywhere among its words, so each of these is
classified. Their features are one- and two-word n-grams; a sparse multinomial logistic regression, trained on the
notices and the paragraphs of the public licence texts below and on text that only sounds like one, weighs those that
matter. A candidate is unknown if its best probability stays below a threshold calibrated on notices left out, or if no
single template of the family holds enough of its n-grams, of which the two-word ones keep the order.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, materialize, text_of

#: Names by which notices call a licence; each fills the patterns of ``NOTICES``.
NAMES = {
    "mit": ("MIT License", "MIT licence", "Expat License"),
    "apache": ("Apache License, Version 2.0", "Apache License", "Apache-2.0"),
    "gpl": ("GNU General Public License, version 3", "GNU General Public License", "GNU GPL version 2", "GPLv3"),
    "lgpl": ("GNU Lesser General Public License", "GNU LGPL version 2.1", "LGPLv3"),
    "bsd": ("BSD License", "3-Clause BSD License", "BSD-2-Clause"),
    "mpl": ("Mozilla Public License, v. 2.0", "Mozilla Public License", "MPL 2.0"),
    "cc": ("CC BY-NC 4.0", "CC BY 4.0", "CC BY-SA 3.0", "Creative Commons Attribution 4.0 International License"),
    "public_domain": ("Unlicense", "CC0 1.0 Universal", "public domain dedication"),
}
NOTICES = (
    "Released under the {}.",
    "Licensed under the {}.",
    "Licensed under {}.",
    "This work is licensed under the {}.",
    "This software is distributed under the terms of the {}.",
    "SPDX-License-Identifier: {}",
    "This file is subject to the terms of the {}.",
    "Available under the {} license.",
    "See LICENSE for the {}.",
)
#: Paragraphs of the public licence texts, or of the notices that these ask for.
PARAGRAPHS = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for additional information regarding copyright ownership.",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
        "You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation, Inc.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "If it is not possible or desirable to put the notice in a particular file, then You may include the notice in a location (such as a LICENSE file in a relevant directory) where a recipient would be likely to look for such a notice.",
        "This Source Code Form is Incompatible With Secondary Licenses, as defined by the Mozilla Public License, v. 2.0.",
    ),
    "cc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy of this license, visit creativecommons.org/licenses or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA.",
        "You are free to share, copy and redistribute the material in any medium or format and to adapt, remix, transform, and build upon the material for any purpose, even commercially, if you give appropriate credit, provide a link to the license, and indicate if changes were made.",
    ),
    "public_domain": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ),
    "reserved": (
        "All rights reserved.",
        "Copyright (c) 2020 Example Corporation. All rights reserved.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
        "This document is confidential and proprietary. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ),
}
#: Words of a piece of a paragraph, as a line of a file would hold it.
PIECE = 12
#: Text of no licence: some of it sounds like one.
OTHER = (
    "He lost his driving license after the accident and could not go to work under these conditions.",
    "The software was released in May and the team is working on version 3 of the public website.",
    "You can obtain a copy of the report at the library free of charge.",
    "She holds a general attribution of powers and may use this file to work on the list.",
    "The public library is open to any person with permission from the city.",
    "This work was distributed in all copies of the newspaper on the same day.",
    "Under the terms of the treaty both sides are subject to the law of the international court.",
    "We sell common tools for any purpose, with or without the box.",
    "The version of the program that you use is not the same as the one on this page.",
    "They were released under the bridge and the name of the river is not known.",
    "The domain of the function is the set of all numbers, and this is its general form.",
    "See the list of the following products and the conditions on the back.",
    "Der Vertrag gilt unter den folgenden Bedingungen, und die Lizenz ist nicht im Preis enthalten.",
    "La licence du logiciel est dans le dossier, avec les conditions du contrat.",
    "La licencia de conducir es para las personas de la ciudad y se usa en el trabajo.",
    "and the of to in is was for it on with are be by an at or from that this",
)
UNKNOWN = "unknown"
SMALL_WORDS = ("the of to in is a an and for as was by it on with are be this that or from at any all you may not its can der die das la le de des les el en un une").split()


def words_of_line(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), r"[^\p{L}\p{N}]+"), "")


def grams(words: Column) -> Column:
    """One- and two-word n-grams."""
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(words, F.filter(pairs, lambda x: x.isNotNull()))


def training_rows() -> list[tuple[str, str, bool]]:
    """Family, paragraph, and whether it is left out for calibration.

    Left out are a third of the patterns with the last name of each family, every second line of a paragraph that is
    broken into lines elsewhere than those learned, and each paragraph with every ninth word dropped.
    """
    # lines that another family's text holds too name neither
    shared = {f: "\n".join(t.lower() for g, texts in PARAGRAPHS.items() if g != f for t in texts) for f in PARAGRAPHS}
    rows = []
    for family, names in NAMES.items():
        for i, name in enumerate(names):
            rows += [(family, n.format(name), i == len(names) - 1 and j % 3 == 0) for j, n in enumerate(NOTICES)]
    for family, paragraphs in PARAGRAPHS.items():
        for text in paragraphs:
            rows.append((family, text, False))
            words = text.split()
            if len(words) > PIECE:
                lines = [(k, False) for k in range(0, len(words) - PIECE // 2, PIECE)] + [(k, True) for k in range(PIECE // 2, len(words) - PIECE, 2 * PIECE)]
                own = [(" ".join(words[k : k + PIECE]), held) for k, held in lines]
                rows += [(family, line, held) for line, held in own if line.lower() not in shared[family]]
                rows.append((family, " ".join(w for k, w in enumerate(words) if k % 9 != 8), True))
    for i, s in enumerate(OTHER):
        rows += [(UNKNOWN, s, i % 5 == 4)]
        rows += [(UNKNOWN, " ".join(s.split()[k : k + 6]), i % 5 == 4) for k in range(0, max(1, len(s.split()) - 5), 2)]
    return rows


def _small(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("r")).select("r.*")


@dataclass(frozen=True)
class Model:
    """Families, intercepts, weights of the n-grams that have any, the threshold, and the n-grams of each template with its family."""

    families: tuple[str, ...]
    intercepts: tuple[float, ...]
    weights: dict[str, tuple[float, ...]]
    threshold: float
    templates: tuple[tuple[str, tuple[str, ...]], ...]


_FITTED: dict[int, Model] = {}


def fit(spark: SparkSession, least_weight: float = 0.05, penalty: float = 0.0005, mix: float = 0.1) -> Model:
    """Train on the notices of this module: a fixed, small set, the same for any corpus."""
    if (known := _FITTED.get(hash((least_weight, penalty, mix)))) is not None:
        return known
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer

    families = (*sorted({*NAMES, *PARAGRAPHS}), UNKNOWN)
    table = _small(spark, [{"label": float(families.index(f)), "line": t, "held": h} for f, t, h in training_rows()], "label:double,line:string,held:boolean")
    table = materialize(table.select("label", "held", F.array_distinct(grams(words_of_line(F.col("line")))).alias("grams")))
    train = table.where("NOT held")
    counter = CountVectorizer(inputCol="grams", outputCol="features", binary=True).fit(train)
    fitted = LogisticRegression(family="multinomial", regParam=penalty, elasticNetParam=mix, maxIter=100, standardization=False).fit(counter.transform(train))
    matrix = fitted.coefficientMatrix.toArray()
    order = [int(i) for i in range(matrix.shape[0])]
    weights = {}
    for j, gram in enumerate(counter.vocabulary):
        column = matrix[:, j] - matrix[:, j].mean()
        content = [w for w in gram.split() if w not in SMALL_WORDS]
        if content and abs(column).max() >= least_weight:
            weights[gram] = tuple(float(column[k]) for k in order)
    templates = {(families[int(row["label"])], tuple(sorted(row["grams"]))) for row in train.where(F.col("label") < len(families) - 1).select("label", "grams").collect()}
    intercepts = tuple(float(x) for x in fitted.interceptVector.toArray())
    # held out: half of the way between the surest other text and the least sure notice that is named rightly
    sure, doubt = [], [1.0 / len(families)]
    for row in table.where("held").select("label", "grams").collect():
        s = [b + sum(weights.get(g, (0.0,) * len(families))[k] for g in row["grams"]) for k, b in enumerate(intercepts)]
        p = [math.exp(x - max(s)) for x in s]
        best = max(range(len(families) - 1), key=p.__getitem__)
        (doubt if row["label"] == len(families) - 1 else sure if best == row["label"] else []).append(p[best] / sum(p))
    sure.sort()
    threshold = min(0.9, max(0.35, (max(doubt) + sure[len(sure) // 10]) / 2))
    model = Model(families, intercepts, weights, threshold, tuple(sorted(templates)))
    _FITTED[hash((least_weight, penalty, mix))] = model
    return model


#: Lengths of windows in words, each half as long again as the one before; they move by a quarter of their length.
#: A notice of 3 to 33 words stands whole in a window less than twice as long, so at least half of that is its own.
WINDOWS = (4, 6, 9, 13, 19, 28, 42)
SENTENCE, LINE, WINDOW = range(3)


def _spans(line: Column, words: Column, known: Column) -> Column:
    """``kind, start, words`` of a line's candidates: its sentences, the line, and windows in which half of the words are known."""
    span = lambda kind, start, ws: F.struct(F.lit(kind).alias("kind"), start.cast("int").alias("start"), ws.alias("words"))
    # the start is the number of words before
    cut = F.aggregate(
        F.split(line, r"(?<=[.!?;])\s+(?=\P{Nd})"),
        F.array().cast("array<struct<kind:int,start:int,words:array<string>>>"),
        lambda done, x: F.concat(done, F.array(span(SENTENCE, F.when(F.size(done) == 0, 0).otherwise(let(F.element_at(done, -1), lambda d: d["start"] + F.size(d["words"]))), words_of_line(x)))).cast("array<struct<kind:int,start:int,words:array<string>>>"),
    )
    out = [F.when(F.size(cut) > 1, cut).otherwise(F.slice(cut, 1, 0)), F.array(span(LINE, F.lit(0), words))]
    for n in WINDOWS:
        starts = F.when(F.size(words) > n, F.array_distinct(F.concat(F.sequence(F.lit(0), F.size(words) - n, F.lit(max(1, n // 4))), F.array(F.size(words) - n)))).otherwise(F.array().cast("array<int>"))
        half = F.filter(starts, lambda i: 2 * F.size(F.filter(F.slice(known, i + 1, n), lambda k: k)) >= n)
        out.append(F.transform(half, lambda i: span(WINDOW, i, F.slice(words, i + 1, n))))
    return F.concat(*out)


def _apart(found: Column) -> Column:
    """The first of ``found``, an array of structs with ``start`` and ``stop``, and each that overlaps none of those taken before."""
    meet = lambda x, y: (x["start"] < y["stop"]) & (y["start"] < x["stop"])
    return F.aggregate(found, F.slice(found, 1, 0), lambda taken, x: F.when(F.exists(taken, lambda y: meet(x, y)), taken).otherwise(F.concat(taken, F.array(x))))


def paragraphs(docs: DataFrame, model: Model, least_share: float = 0.5, id_col: str = "doc_id", text_col: str = "text", least_cover: float = 0.7) -> DataFrame:
    """``doc_id, text_hash, paragraph, family, probability, template_share`` of the notices by which a licence is confirmed.

    A notice is a sentence of the line, the line, or a window of its words, whichever comes first; others that overlap
    it don't count. Each is classified by its own words, at least ``least_share`` of whose n-grams one template of the
    family holds. A window, which may be any fragment, must also have ``least_cover`` of the n-grams of that template.
    """
    spark = docs.sparkSession
    # text without any of these words has no n-gram that speaks for a family rather than against all, so it is unknown
    bare = max(model.intercepts[:-1]) - model.intercepts[-1]
    if bare >= math.log(model.threshold / (1 - model.threshold)):
        raise ValueError("a text without words would have a licence")
    gate = sorted({next(w for w in sorted(g.split(), key=len, reverse=True) if w not in SMALL_WORDS) for g, w in model.weights.items() if max(w[:-1]) > w[-1]})
    in_templates = sorted({g for _, t in model.templates for g in t})
    own = F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"))
    lines = docs.select(own.alias("own"), F.posexplode(F.split(text_of(text_col), "\n", -1)).alias("paragraph", "line"))
    lines = lines.select("own.*", "paragraph", "line", words_of_line(F.col("line")).alias("words")).where(F.exists("words", lambda w: w.isin(gate)))
    known = F.transform("words", lambda w: w.isin([g for g in in_templates if " " not in g]))
    spans = lines.select("doc_id", "text_hash", "paragraph", let(F.struct("line", "words", known.alias("known")), lambda r: _spans(r["line"], r["words"], r["known"])).alias("spans"))
    meant = F.filter("spans", lambda x: F.exists(x["words"], lambda w: w.isin(gate)))
    cut = F.transform(meant, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), (x["start"] + F.size(x["words"])).alias("stop"), F.array_distinct(grams(x["words"])).alias("grams")))
    likely = F.filter(cut, lambda x: F.size(F.filter(x["grams"], lambda g: g.isin(in_templates))) >= least_share * F.size(x["grams"]))
    key = ["doc_id", "text_hash", "paragraph", "kind", "start", "stop"]
    found = spans.select("doc_id", "text_hash", "paragraph", F.inline(likely))
    held = sorted({*in_templates, *model.weights})
    rows = [{"gram": g, "k": k, "w": model.weights.get(g, (0.0,) * len(model.families))} for k, g in enumerate(held)]
    table = _small(spark, rows, "gram:string,k:int,w:array<double>")
    each = found.select(*key, F.size("grams").alias("n"), F.explode("grams").alias("gram")).join(table, "gram", "left")
    scores = [F.coalesce(F.sum(F.col("w")[k]), F.lit(0.0)).alias(f"s{k}") for k in range(len(model.families))]
    summed = each.groupBy(*key).agg(F.first("n").alias("n"), F.collect_list("k").alias("ks"), *scores)
    families = model.families[:-1]
    rows = summed.select(*key, "n", "ks", F.array(*(F.col(f"s{k}") + F.lit(b) for k, b in enumerate(model.intercepts))).alias("s"))
    powers = let(F.col("s"), lambda s: F.transform(s, lambda x: F.exp(x - F.array_max(s))))
    chances = let(powers, lambda e: F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y)))
    named = F.transform(F.slice(chances, 1, len(families)), lambda p, k: F.struct(F.round(p, 6).alias("p"), F.get(F.split(F.lit(",".join(families)), ","), k).alias("family")))
    judged = rows.select(*key, "n", "ks", F.array_max(named).alias("best"))
    sure = judged.select(*key, "n", "ks", F.col("best.family").alias("family"), F.col("best.p").alias("probability")).where(F.col("probability") >= model.threshold)
    # the family's templates by n-gram: number of the template and its size
    numbers = {g: k for k, g in enumerate(held)}
    parts = [{"k": numbers[g], "family": f, "i": i, "whole": len(t)} for i, (f, t) in enumerate(model.templates) for g in t]
    met = sure.select(*key, "n", "family", "probability", F.explode("ks").alias("k")).join(_small(spark, parts, "k:int,family:string,i:int,whole:int"), ["k", "family"])
    by = met.groupBy(*key, "n", "family", "probability", "i", "whole").agg(F.count("*").alias("t"))
    fits = (F.col("t") >= least_share * F.col("n")) & ((F.col("kind") < WINDOW) | (F.col("t") >= least_cover * F.col("whole")))
    confirmed = by.where(fits).groupBy(*key, "n", "family", "probability").agg(F.max("t").alias("t")).withColumn("template_share", F.round(F.col("t") / F.col("n"), 6))
    ranked = F.struct("kind", (-F.col("t")).alias("t"), (-F.col("probability")).alias("p"), "start", "stop", "family", "probability", "template_share")
    taken = confirmed.groupBy("doc_id", "text_hash", "paragraph").agg(F.array_sort(F.collect_list(ranked)).alias("found"))
    return taken.select("doc_id", "text_hash", "paragraph", F.inline(_apart(F.col("found")))).select("doc_id", "text_hash", "paragraph", "family", "probability", "template_share")


def scan(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, license, probability, n_paragraphs, families``.

    ``license`` is the family of the surest notice, ties to the smaller name; ``n_paragraphs`` counts the lines that hold
    any, and ``families`` lists all that were found, by name, joined by commas. Rows without a confirmed notice, null and
    empty texts among them, get ``none``, a null probability, 0 and an empty list. Rows that repeat an id are judged by
    their own text. An empty table gives an empty result; other columns are ignored.
    """
    model = model or fit(docs.sparkSession)
    found = paragraphs(docs, model, id_col=id_col, text_col=text_col)
    best = found.groupBy("doc_id", "text_hash").agg(
        F.min(F.struct((-F.col("probability")).alias("p"), "family", "probability")).alias("best"), F.count_distinct("paragraph").alias("n"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families")
    )
    best = materialize(best).withColumnRenamed("doc_id", "found_id")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("own_hash"))
    met = rows.join(best, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("own_hash") == F.col("text_hash")), "left")
    return met.select(
        "doc_id", F.coalesce("best.family", F.lit("none")).alias("license"), F.col("best.probability").alias("probability"), F.coalesce("n", F.lit(0)).cast("long").alias("n_paragraphs"), F.coalesce("families", F.lit("")).alias("families")
    )
