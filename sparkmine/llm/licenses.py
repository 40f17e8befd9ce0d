"""Operator 5: license scans, in built-in functions and Spark ML only.

A paragraph is a line of a document.  Its features are the word bigrams and
trigrams (lower case, without punctuation) that occur in the licence templates.

1. *Training.* A multinomial logistic regression with elastic net (sparse
   weights) over the families and ``none``.  Positive rows are runs of words of the
   notices and the licences' names in ``CARRIERS``; negative rows are the fixed
   ``OTHER_TEXTS`` and a bounded sample of corpus paragraphs that share no trigram
   with a template.
2. *Calibration.* On rows kept out of the fit, a one-variable logistic regression
   of "names a family" on the margin between the best family and ``none`` gives a
   probability; below one half the paragraph is ``unknown``.
3. *Scan.* A paragraph that holds no template bigram has the intercept as its
   score, where ``none`` is highest; one regular expression over all template bigrams
   finds it exactly, before it is cut into words.  In the others, each position
   with a template bigram carries two 64-bit hashes (bigram, trigram); a broadcast
   join with the model's n-grams (bounded by the templates) gives their weights.
   Scores are sums per paragraph.
4. *Confirmation.* A family is confirmed if the paragraph's bigrams and trigrams
   cover at least half of one of its templates, or half of the paragraph's lie in
   one.  Unconfirmed ones count as ``unknown``.

Defined cases: null and empty texts name nothing; a licence named in several
paragraphs counts once per document; repeated rows give repeated results; rows
that share a doc_id are told apart by their text; of families with equal scores
the first by name counts; a notice wrapped over several lines is judged line by
line; very long texts are scanned whole; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm.common import SPACES, cut_lineage, documents

# Names of public licences by family.
NAMES = {
    "AGPL": ["GNU Affero General Public License", "GNU AGPL", "AGPL v3", "AGPLv3", "AGPL-3.0", "AGPL-3.0-or-later", "AGPL-3.0-only"],
    "Apache-2.0": ["Apache License", "Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0", "Apache v2"],
    "Artistic-2.0": ["Artistic License", "Artistic License 2.0", "Artistic-2.0", "Perl Artistic License"],
    "BSD": ["BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "BSD-2-Clause", "BSD-3-Clause", "New BSD License", "Simplified BSD License", "BSD-style license"],
    "BSL-1.0": ["Boost Software License", "Boost Software License, Version 1.0", "Boost License", "BSL-1.0"],
    "CC-BY": ["CC BY 4.0", "CC BY 3.0", "CC BY", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution License"],
    "CC-BY-NC": ["CC BY-NC 4.0", "CC BY-NC", "CC BY-NC-SA 4.0", "CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial License"],
    "CC-BY-SA": ["CC BY-SA 4.0", "CC BY-SA 3.0", "CC BY-SA", "Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution-ShareAlike License"],
    "CC0": ["CC0 1.0", "CC0 1.0 Universal", "CC0-1.0", "CC0 Public Domain Dedication", "Creative Commons Zero"],
    "EPL-2.0": ["Eclipse Public License", "Eclipse Public License 2.0", "Eclipse Public License v2.0", "EPL-2.0", "EPL 2.0"],
    "GPL": ["GNU General Public License", "GNU General Public License, version 3", "GNU General Public License, version 2", "GNU GPL", "GPL v2", "GPL v3", "GPLv2", "GPLv3", "GPL-2.0", "GPL-3.0", "GPL-2.0-only", "GPL-3.0-or-later"],
    "ISC": ["ISC License", "ISC"],
    "LGPL": ["GNU Lesser General Public License", "GNU Lesser General Public License, version 2.1", "GNU Library General Public License", "GNU LGPL", "LGPL v3", "LGPLv3", "LGPL-2.1", "LGPL-3.0", "LGPL-2.1-or-later"],
    "MIT": ["MIT License", "The MIT License", "MIT licence", "MIT"],
    "MPL-2.0": ["Mozilla Public License", "Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPL-2.0", "MPL v2"],
    "Unlicense": ["The Unlicense", "Unlicense"],
    "Zlib": ["zlib License", "zlib/libpng License", "Zlib"],
}
# Phrases in which a name stands when a text is put under it.
CARRIERS = [
    "{}",
    "License: {}",
    "Licensed under {}",
    "Licensed under the {}.",
    "Released under the {}.",
    "Available under the {}.",
    "Distributed under the terms of the {}.",
    "This project is licensed under the {}",
    "This work is released under the {}",
    "SPDX-License-Identifier: {}",
]
# How a name of a single word must stand to confirm its family.
SHORT_CARRIERS = ["under {}", "under the {}", "License {}", "Identifier {}"]
# The opening sentences of public licence texts by family.
NOTICES = {
    "AGPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "Apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "Artistic-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ],
    "GPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "MIT": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely.",
    ],
}
#: What confirms a family: its notices, its names, and names of one word inside a short carrier.
TEMPLATES = {f: NOTICES[f] + [c.format(n) for n in names for c in (SHORT_CARRIERS if n.isalnum() else ["{}"])] for f, names in NAMES.items()}
# Sentences with licence words that grant nothing.
OTHER_TEXTS = [
    "The driver showed the officer a valid license.",
    "He lost his fishing license and paid a fine.",
    "The general public was not admitted to the hall.",
    "The album was released under the title of its first song.",
    "Permission is required before you enter the site.",
    "All rights reserved.",
    "The work is subject to the terms of the contract.",
    "This work is one of the best in the series.",
    "You may not use this door in case of fire.",
    "The foundation published the report in version 3.",
    "Software is sold with or without support.",
    "The license of the bar was withdrawn by the city.",
    "She studied at the MIT and later taught there.",
    "The Apache people lived in the south of the country.",
    "The Mozilla foundation published a report.",
    "A creative mind and a common attribution of the quote.",
    "The painting is in the public domain.",
    "Version 2.0 of the report was released under the old name.",
    "The program is available under the menu of the house.",
    "The commons were open to any person.",
    "The eclipse was seen by the public in version 2.0 of the park.",
    "Products are distributed under the terms of the contract.",
    "The library is free and open to the public.",
    "The licence for the shop is renewed by the city.",
]
NONE, UNKNOWN = "none", "unknown"
#: Corpus paragraphs taken as negative rows (the first of a hash order).
NEGATIVES = 1500
COVER = 0.5
#: What separates the words of ``_words``: white space and ASCII punctuation.
_BREAK = r"[\x20\x09-\x0D\p{Punct}]"


def _words(text: Column) -> Column:
    """Lower-case words without ASCII punctuation."""
    return F.array_remove(F.split(F.lower(F.regexp_replace(text, r"[\p{Punct}]", " ")), SPACES), "")


def _grams(text: Column) -> Column:
    """Bigrams and trigrams of a text's words as one array of strings."""
    w = _words(text)
    two = F.zip_with(w, F.slice(w, 2, 1 << 30), lambda a, b: F.concat(a, F.lit(" "), b))
    three = F.zip_with(two, F.slice(w, 3, 1 << 30), lambda a, b: F.concat(a, F.lit(" "), b))
    # zip_with pads the shorter side with nulls, which concat carries on
    return F.array_distinct(F.array_compact(F.concat(two, three)))


def _word_runs(text: str) -> list[str]:
    """The whole text and every run of 60% of its words or more."""
    w = text.split()
    least = max(3, -(-6 * len(w) // 10))
    return [" ".join(w[i : i + n]) for n in range(least, len(w) + 1) for i in range(len(w) - n + 1)] or [text]


def _prefix_tree(words: list[str]) -> str:
    """A regular expression for any of the words, branching letter by letter."""
    by: dict[str, list[str]] = {}
    for w in words:
        if w:
            by.setdefault(w[0], []).append(w[1:])
    if not by:
        return ""
    branches = [f"\\x{{{ord(c):X}}}{_prefix_tree(rest)}" if c != " " else f"{_BREAK}+{_prefix_tree(rest)}" for c, rest in sorted(by.items())]
    return f"(?:{'|'.join(branches)}){'?' if '' in words else ''}"


def _has_bigram(text: Column, bigrams: list[str]) -> Column:
    """True if two consecutive words of the text, as ``_words`` cuts them, are one of ``bigrams``."""
    return F.lower(text).rlike(f"(?:\\A|{_BREAK}){_prefix_tree(sorted(set(bigrams)))}(?:{_BREAK}|\\z)")


def _examples(spark: SparkSession, sample: DataFrame) -> DataFrame:
    """(text, family) rows: template runs, fixed other texts, the corpus sample."""
    rows = [(run, family) for family, texts in NOTICES.items() for t in texts for run in _word_runs(t)[-60:]]
    rows += [(c.format(name), family) for family, names in NAMES.items() for name in names for c in CARRIERS]
    rows += [(run, NONE) for t in OTHER_TEXTS for run in _word_runs(t)[-10:]]
    fixed = spark.createDataFrame(rows, "text string, family string")
    templates = spark.createDataFrame([(t,) for texts in TEMPLATES.values() for t in texts], "text string")
    known = F.broadcast(templates.select(F.explode(_grams(F.col("text"))).alias("g")).where(F.size(F.split("g", " ")) == 3).distinct())
    clash = sample.select("text", F.explode(_grams(F.col("text"))).alias("g")).join(known, "g").select("text").distinct()
    return fixed.unionByName(sample.join(F.broadcast(clash), "text", "left_anti").select("text", F.lit(NONE).alias("family")))


class Model:
    """Template bigrams, weights per n-gram hash and class as a small table, intercepts, calibration."""

    def __init__(self, bigrams, classes, intercepts, weights, slope, offset):
        self.bigrams, self.classes, self.intercepts, self.weights, self.slope, self.offset = bigrams, classes, intercepts, weights, slope, offset


def _key(gram: Column) -> Column:
    return F.xxhash64(gram)


def train(spark: SparkSession, paragraphs: DataFrame, negatives: int = NEGATIVES) -> Model:
    """Fit and calibrate; ``paragraphs`` has a column ``text``."""
    long_enough = paragraphs.where(F.length("text") > 20).select("text")
    order = F.xxhash64("text")
    # a bound on the hash leaves some three times the rows wanted, over the whole corpus, before they meet in one task
    different = long_enough.agg(F.approx_count_distinct(order)).head()[0]
    if different > 4 * negatives:
        long_enough = long_enough.where(order < int(-(2**63) + 3 * negatives * 2**64 // different))
    sample = cut_lineage(long_enough.distinct().orderBy(order, "text").limit(negatives))
    # a few thousand short rows (templates and ``negatives``): one partition keeps the solver's rounds short
    rows = cut_lineage(_examples(spark, sample).withColumn("grams", _grams(F.col("text"))).coalesce(1))
    classes = [NONE, *TEMPLATES]
    index = F.array_position(F.array(*map(F.lit, classes)), F.col("family")).cast("double") - 1
    vocabulary = sorted(r["g"] for r in rows.where(F.col("family") != NONE).select(F.explode("grams").alias("g")).distinct().collect())  # bounded by the templates
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features").setBinary(True).transform(rows.withColumn("label", index))
    fold = F.pmod(F.xxhash64("text", F.lit(5)), F.lit(5)) == 0
    lr = LogisticRegression(family="multinomial", regParam=2e-4, elasticNetParam=0.5, maxIter=40, standardization=False)
    fitted = lr.fit(vectors.where(~fold))
    scored = fitted.transform(vectors.where(fold)).select("label", "rawPrediction")
    raw = vector_to_array("rawPrediction")
    margin = F.array_max(F.slice(raw, 2, len(classes) - 1)) - raw[0]
    held = scored.select((F.col("label") > 0).cast("double").alias("label"), array_to_vector(F.array(margin)).alias("features"))
    platt = LogisticRegression(regParam=0.01, maxIter=50).fit(held)
    matrix = fitted.coefficientMatrix.toArray()
    table = [(g, [float(matrix[c][j]) for c in range(len(classes))]) for j, g in enumerate(vocabulary)]
    weights = spark.createDataFrame(table, "gram string, w array<double>").select(_key(F.col("gram")).alias("key"), (F.size(F.split("gram", " ")) == 3).alias("tri"), "w")
    return Model([g for g in vocabulary if g.count(" ") == 1], classes, [float(x) for x in fitted.interceptVector], weights, float(platt.coefficients[0]), float(platt.intercept))


def paragraphs_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line, text, version): the non-blank lines; ``version`` tells rows with equal ids apart."""
    lines = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("version"), F.posexplode(F.split(F.col(text_col), "\n")).alias("line", "text"))
    return lines.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, version, line, family, probability, cover): every paragraph that
    names a family or, as ``unknown``, something close to one."""
    spark = docs.sparkSession
    near = paragraphs_of(docs.where(_has_bigram(F.col(text_col), model.bigrams)), id_col, text_col).where(_has_bigram(F.col("text"), model.bigrams))
    lines = near.select("doc_id", "version", "line", _words(F.col("text")).alias("w"))
    two = F.zip_with("w", F.slice("w", 2, 1 << 30), lambda a, b: F.concat(a, F.lit(" "), b))
    grams = F.zip_with(two, F.slice("w", 3, 1 << 30), lambda a, b: F.struct(a.alias("two"), F.concat(a, F.lit(" "), b).alias("three")))
    known = F.filter(grams, lambda g: F.coalesce(g["two"].isin(model.bigrams), F.lit(False)))
    pairs = F.transform(known, lambda g: F.struct(_key(g["two"]).alias("two"), F.when(g["three"].isNotNull(), _key(g["three"])).alias("three")))
    each = lines.select("doc_id", "version", "line", F.size("w").alias("n"), F.explode(pairs).alias("p"))
    one = [f"w[{c}] AS w{c}" for c in range(len(model.classes))]
    names = [f"w{c}" for c in range(len(model.classes))]
    bigrams = F.broadcast(model.weights.where(~F.col("tri")).selectExpr("key AS two", *one))
    key = ["doc_id", "version", "line", "n"]
    # few positions are left after this join; they are written, so the words are gone over once
    hits = cut_lineage(each.select(*key, F.col("p.two").alias("two"), F.col("p.three").alias("three")).join(bigrams, "two"))
    trigrams = F.broadcast(model.weights.where(F.col("tri")).selectExpr("key AS three", *one))
    found = hits.select(*key, F.col("two").alias("g"), *names).unionByName(hits.select(*key, "three").join(trigrams, "three").select(*key, F.col("three").alias("g"), *names))
    scores = found.groupBy(*key, "g").agg(*(F.first(c).alias(c) for c in names)).groupBy(*key).agg(*((F.sum(c) + F.lit(b)).alias(c) for c, b in zip(names, model.intercepts)))
    best = F.greatest(*names[1:])
    family = F.coalesce(*(F.when(F.col(c) == best, F.lit(f)) for c, f in zip(names[1:], model.classes[1:])))
    probability = 1 / (1 + F.exp(-(F.lit(model.slope) * (best - F.col("w0")) + F.lit(model.offset))))
    judged = scores.select(*key, family.alias("best"), probability.alias("probability"))
    templates = spark.createDataFrame([(f, i, t) for f, texts in TEMPLATES.items() for i, t in enumerate(texts)], "best string, template int, text string")
    grams = templates.select("best", "template", F.explode(_grams(F.col("text"))).alias("g"))
    sizes = grams.groupBy("best", "template").agg(F.count(F.lit(1)).alias("size"))
    grams = F.broadcast(grams.join(sizes, ["best", "template"]).select("best", "template", "size", _key(F.col("g")).alias("g")))
    own = hits.select(*key, F.explode(F.array("two", "three")).alias("g"))
    shared = own.distinct().join(grams, "g").groupBy(*key, "best", "template").agg(F.count(F.lit(1)).alias("m"), F.first("size").alias("size"))
    cover = F.greatest(F.col("m") / F.col("size"), F.col("m") / F.greatest(2 * F.col("n") - 3, F.lit(1)))
    compared = shared.groupBy("doc_id", "version", "line", "best").agg(F.max(cover).alias("cover"))
    same = (F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))) & (F.col("a.version") == F.col("b.version")) & (F.col("a.line") == F.col("b.line")) & (F.col("a.best") == F.col("b.best"))
    both = judged.alias("a").join(compared.alias("b"), same, "left").select("a.doc_id", "a.version", "a.line", "a.best", "a.probability", F.coalesce("b.cover", F.lit(0.0)).alias("cover"))
    named = (F.col("probability") >= 0.5) & (F.col("cover") >= COVER)
    close = (F.col("probability") >= 0.5) | (F.col("cover") >= COVER)
    return both.where(close).select("doc_id", "version", "line", F.when(named, F.col("best")).otherwise(F.lit(UNKNOWN)).alias("family"), "probability", "cover")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5 over every whole text of ``documents``: per document the
    licence families it names and the number of unknown licence-like paragraphs."""
    docs = documents(spark, sf_dir)
    model = train(spark, paragraphs_of(docs).select("text"))
    found = scan(docs, model).groupBy("doc_id", "version").agg(
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("family") != UNKNOWN, F.col("family")))), ",").alias("licenses"), F.count_if(F.col("family") == UNKNOWN).alias("n_unknown")
    )
    own = docs.select("doc_id", F.xxhash64("text").alias("own")).alias("d")
    joined = own.join(found.alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.own") == F.col("f.version")), "left")
    return joined.select("d.doc_id", F.coalesce("licenses", F.lit("")).alias("licenses"), F.coalesce("n_unknown", F.lit(0)).cast("long").alias("n_unknown"))
