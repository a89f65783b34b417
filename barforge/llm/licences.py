"""Licence scan: a trained paragraph classifier. Column functions and Spark's own
learners only.

A paragraph is a line with a word. Its words, word pairs and triples are sparse
features of a multinomial logistic regression over licence families and an
"unknown" class. Positives are notices of every family in several settings,
negatives a bounded sample of the corpus' own paragraphs without a licence cue;
the probability from which a family is believed comes from held-out examples.
A prediction stands when a template of the family also shares enough word
pairs with the paragraph.

A family can only win where an n-gram speaks for it, so every n-gram that speaks
for some family names one trigger word (its rarest), and only paragraphs with a
trigger are scored; all others are unknown by the model itself.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barforge.llm.common import written

UNKNOWN = "unknown"
#: Notices by family (fixed values): what people write to name a licence, and its telling sentences.
TEMPLATES = {
    "agpl": ["Licensed under the GNU Affero General Public License, version 3.",
             "This program is distributed under the terms of the GNU Affero General Public License.",
             "Released under the AGPL v3 license.", "SPDX-License-Identifier: AGPL-3.0-or-later"],
    "apache": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License 2.0.",
               "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
               "Distributed under the Apache 2.0 license.", "SPDX-License-Identifier: Apache-2.0"],
    "bsd": ["Licensed under the BSD 3-Clause License.", "Released under the BSD 2-Clause License.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
            "Distributed under a BSD-style license.", "SPDX-License-Identifier: BSD-3-Clause"],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
              "Released under the Creative Commons Attribution license.", "SPDX-License-Identifier: CC-BY-4.0"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                 "Released under CC BY-NC-SA 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
                 "Text is available under the Creative Commons Attribution-ShareAlike License.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.", "Released under the GNU GPL v2.",
            "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
            "Distributed under the GPL license.", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "lgpl": ["Licensed under the GNU Lesser General Public License, version 2.1.", "Released under the LGPL v3 license.",
             "This library is distributed under the terms of the GNU Lesser General Public License.", "SPDX-License-Identifier: LGPL-2.1-only"],
    "mit": ["Released under the MIT License.", "Licensed under the MIT license.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
            "Distributed under the terms of the MIT License.", "SPDX-License-Identifier: MIT"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
            "Licensed under the Mozilla Public License 2.0.", "Released under the MPL 2.0 license.", "SPDX-License-Identifier: MPL-2.0"],
    "proprietary": ["All rights reserved.", "Copyright the authors. All rights reserved.",
                    "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
                    "No part of this publication may be reproduced without prior written permission."],
    "public-domain": ["This work is released into the public domain.", "Dedicated to the public domain under CC0 1.0 Universal.",
                      "This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: CC0-1.0"],
}
FAMILIES = (*sorted(TEMPLATES), UNKNOWN)
#: Settings a notice is met in (fixed values): text before and behind it.
SETTINGS = [("", ""), ("Copyright 2021 the authors. ", ""), ("Note: ", " See the file for details."),
            ("This project is open to all. ", ""), ("", " For more information visit the site."),
            ("The code in this archive, unless stated otherwise: ", " Thank you.")]
CUE = "(?i)licen[sc]|copyright|public domain|rights reserved|permission|spdx|proprietary|redistribut"
NEGATIVES = 3000
NEGATIVE_CHARS = 2000
VOCABULARY = 5000
#: n-grams in more than this share of the negatives are no features.
COMMON_SHARE = 0.01
PRECISION = 0.98
SHARED_PAIRS = 0.5


def words_of(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]+(?:\.[0-9]+)*"), F.lit(0))


def ngrams_of(words: str, sizes: tuple[int, ...] = (1, 2, 3)) -> Column:
    """Word n-grams of an array column, words joined by one space."""
    def grams(n: int) -> Column:
        at = F.sequence(F.lit(1), F.size(words) - (n - 1))
        return F.when(F.size(words) >= n, F.transform(at, lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(
            F.array().cast("array<string>"))
    return F.concat(*map(grams, sizes))


def template_rows(spark: SparkSession) -> DataFrame:
    """(family, template, words) of the notices."""
    rows = F.array(*(F.struct(F.lit(f).alias("family"), F.lit(t).alias("template")) for f, ts in sorted(TEMPLATES.items()) for t in ts))
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.*").withColumn("words", words_of(F.col("template")))


def examples(docs: DataFrame, text_col: str = "text", negatives: int = NEGATIVES) -> DataFrame:
    """(family, words, held_out): notices in their settings, whole and cut, and
    at most ``negatives`` distinct paragraphs of the corpus without a licence
    cue, of up to NEGATIVE_CHARS characters (those with the smallest hash; each
    document offers one)."""
    known = template_rows(docs.sparkSession)
    whole = known.select("family", F.explode(F.array(*(
        F.concat(F.lit(a), F.col("template"), F.lit(b)) for a, b in SETTINGS))).alias("body"))
    half = known.where(F.size("words") >= 6).select("family", F.explode(F.array(
        F.array_join(F.slice("words", 1, F.ceil(F.size("words") * 0.75).cast("int")), " "),
        F.array_join(F.expr("slice(words, cast(floor(size(words) * 0.25) as int) + 1, size(words))"), " "))).alias("body"))
    line = lambda t: F.filter(F.split(t, "\n"), lambda x: (F.length(x) <= NEGATIVE_CHARS) & x.rlike(r"\p{L}") & ~x.rlike(CUE))
    offered = docs.select(F.array_min(F.transform(line(F.col(text_col).cast("string")), lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("body")))).alias("p"))
    other = offered.where("p is not null").select("p.*").orderBy("h", "body").limit(negatives).distinct()
    rows = whole.union(half).union(other.select(F.lit(UNKNOWN), "body"))
    return rows.select("family", words_of(F.col("body")).alias("words"), (F.pmod(F.xxhash64("body"), F.lit(5)) == 0).alias("held_out"))


class LicenceModel:
    """The fitted vocabulary and regression, the calibrated probability and the
    trigger words."""

    def __init__(self, vectors: CountVectorizerModel, regression: LogisticRegressionModel, least: float, triggers: list[str] | None):
        self.vectors, self.regression, self.least, self.triggers = vectors, regression, least, triggers

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with words) and family, probability: the most probable
        family, or unknown where it falls short of the calibrated probability."""
        out = self.regression.transform(self.vectors.transform(rows.withColumn("_grams", F.array_distinct(ngrams_of("words")))))
        p = vector_to_array("probability")
        best = F.array_max(F.slice(p, 1, len(FAMILIES) - 1))
        family = F.get(F.array(*map(F.lit, FAMILIES)), (F.array_position(p, best) - 1).cast("int"))
        return out.select(*rows.columns, F.when(best >= self.least, family).otherwise(UNKNOWN).alias("family"), best.alias("probability"))


def fit(docs: DataFrame, text_col: str = "text", negatives: int = NEGATIVES, vocabulary: int = VOCABULARY,
        precision: float = PRECISION) -> LicenceModel:
    """Fit on the fixed notices and a bounded sample of the corpus."""
    rows = written(examples(docs, text_col, negatives).withColumn("grams", F.array_distinct(ngrams_of("words"))).coalesce(1), "licence-examples")
    grams = rows.where("not held_out").select((F.col("family") == UNKNOWN).alias("other"), F.explode("grams").alias("gram"))
    seen = grams.groupBy("gram").agg(F.sum((~F.col("other")).cast("int")).alias("known"), F.sum(F.col("other").cast("int")).alias("others"))
    n_other = rows.where((F.col("family") == UNKNOWN) & ~F.col("held_out")).count()
    kept = seen.where((F.col("known") >= 2) & (F.col("others") <= COMMON_SHARE * n_other)).orderBy(F.col("known").desc(), "gram").limit(vocabulary)
    others = {r["gram"]: r["others"] for r in seen.where("known > 0 and gram not like '% %'").select("gram", "others").limit(vocabulary).collect()}
    vocab = [r["gram"] for r in kept.select("gram").collect()]
    vectors = CountVectorizerModel.from_vocabulary(vocab, "_grams", "_features")
    vectors.setBinary(True)
    label = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")) - 1
    table = vectors.transform(rows.withColumn("_grams", F.col("grams"))).withColumns({
        "_label": label.cast("double"), "_weight": F.when(F.col("family") == UNKNOWN, 1.0).otherwise(5.0)}).cache()
    regression = LogisticRegression(featuresCol="_features", labelCol="_label", weightCol="_weight", family="multinomial", regParam=0.0002,
                                    elasticNetParam=0.1, maxIter=100, standardization=False).fit(table.where("not held_out"))
    # calibration: the lowest probability at which held-out predictions are precise
    held = regression.transform(table.where("held_out"))
    p = vector_to_array("probability")
    best = F.array_max(F.slice(p, 1, len(FAMILIES) - 1))
    held = held.select(best.alias("p"), (F.array_position(p, best) - 1 == F.col("_label")).cast("int").alias("hit"))
    down = Window.orderBy(F.col("p").desc())  # a fifth of a bounded sample
    held = held.withColumns({"good": F.sum("hit").over(down), "all": F.count(F.lit(1)).over(down)})
    least = held.where((F.col("p") >= 0.5) & (F.col("good") + 1 >= precision * (F.col("all") + 1))).agg(F.min("p").alias("p")).first()["p"]
    least = 0.5 if least is None else max(0.5, least)
    table.unpersist()
    return LicenceModel(vectors, regression, least, _triggers(vocab, regression, others, least))


def _triggers(vocab: list[str], regression: LogisticRegressionModel, others: dict[str, int], least: float) -> list[str] | None:
    """Words without any of which no family reaches ``least``: one word of every
    n-gram that speaks for a family against unknown, less the most common words
    whose n-grams together cannot lift any family to ``least``. None if the
    intercepts alone do."""
    weights, bias = regression.coefficientMatrix.toArray().tolist(), list(regression.interceptVector)
    # the lead over unknown that a family needs, and what the intercepts give it
    need = math.log(least / (1 - least)) if least < 1 else math.inf
    room = [need - (b - bias[-1]) for b in bias[:-1]]
    if min(room) <= 0:
        return None
    lifts: dict[str, list[float]] = {}
    for j, gram in enumerate(vocab):
        lift = [max(0.0, w[j] - weights[-1][j]) for w in weights[:-1]]
        if any(lift):
            word = min(gram.split(" "), key=lambda w: (others.get(w, 0), -len(w), w))
            lifts[word] = [a + b for a, b in zip(lifts.get(word, [0.0] * len(lift)), lift)]
    for word in sorted(lifts, key=lambda w: (-others.get(w, 0), len(w), w)):
        less = [r - x for r, x in zip(room, lifts[word])]
        if others.get(word, 0) and min(less) > 0:
            room = less
            del lifts[word]
    return sorted(lifts)


def licence_paragraphs(docs: DataFrame, model: LicenceModel, id_col: str = "doc_id", text_col: str = "text",
                       shared_pairs: float = SHARED_PAIRS) -> DataFrame:
    """(doc_id, text_hash, paragraph, family, probability, template, similarity,
    confirmed) of every paragraph that is predicted a family; paragraph counts
    lines from 0. Repeated rows count once; null text has no paragraphs."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text, F.lit(1)).alias("text_hash"), text.alias("t"))
    if model.triggers is not None:
        some = r"(?<![\p{L}\p{N}])(?:" + "|".join(map(re.escape, model.triggers)) + r")(?![\p{L}\p{N}])" if model.triggers else "(?!)"
        rows = rows.where(F.lower("t").rlike(some))
    rows = rows.select("doc_id", "text_hash", F.posexplode(F.split("t", "\n")).alias("paragraph", "body"))
    rows = rows.where(F.lower("body").rlike(some) if model.triggers is not None else F.col("body").rlike(r"\p{L}"))
    rows = rows.withColumn("words", words_of(F.col("body"))).drop("body").dropDuplicates(["doc_id", "text_hash", "paragraph"])
    # written before and after scoring: a filter on the family would otherwise be
    # pushed below and repeat the words and n-grams in every part of the score
    rows = written(rows, "licence-paragraphs").repartition("doc_id", "text_hash", "paragraph")
    scored = written(model.score(rows), "licence-scored").where(F.col("family") != UNKNOWN)
    # template comparison: shared word pairs over those of the shorter side
    pairs = lambda df: df.withColumn("pairs", F.array_distinct(ngrams_of("words", (2,))))
    templates = pairs(template_rows(docs.sparkSession)).select("family", "template", F.col("pairs").alias("t_pairs"))
    by_family = templates.groupBy("family").agg(F.collect_list(F.struct("template", "t_pairs")).alias("templates"))
    both = pairs(scored).join(F.broadcast(by_family), "family")  # one row per family
    share = F.transform("templates", lambda t: F.struct(
        (F.size(F.array_intersect("pairs", t["t_pairs"])) / F.greatest(F.lit(1), F.least(F.size("pairs"), F.size(t["t_pairs"])))).alias("similarity"),
        t["template"].alias("template")))
    best = both.withColumn("best", F.array_max(share))
    return best.select("doc_id", "text_hash", "paragraph", "family", "probability", "best.template", "best.similarity",
                       (F.col("best.similarity") >= shared_pairs).alias("confirmed"))


def scan(docs: DataFrame, model: LicenceModel | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """With ``model``, or one fitted on ``docs``: one row per row of ``docs`` with doc_id, n_paragraphs (lines with a word),
    n_licence (paragraphs with a confirmed family), families (distinct, sorted),
    probability (the highest confirmed one, null without any). Null text has no
    paragraphs; null ids and repeated rows stay; an empty table gives an empty
    result; other columns are ignored."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = licence_paragraphs(docs, model or fit(docs, text_col), id_col, text_col).where("confirmed")
    found = found.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("family")).alias("families"), F.max("probability").alias("probability"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text, F.lit(1)).alias("text_hash"),
                       F.size(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))).cast("bigint").alias("n_paragraphs"))
    out = rows.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    return out.select("doc_id", "n_paragraphs", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_licence"),
                      F.coalesce("families", F.array().cast("array<string>")).alias("families"), "probability")
