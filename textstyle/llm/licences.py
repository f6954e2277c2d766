"""Licence scan of paragraphs, with DataFrame expressions and MLlib only.

A multinomial logistic regression over single words and pairs of neighbouring
words, with an elastic net that leaves few of them, names a paragraph's
licence family. Its positive examples are cut from the notices below, its
negative ones from the corpus and from sentences that speak of licences
without granting one. Notices of licences outside the list are a class of their
own, ``unknown``. A temperature and how sure a family must be are fitted on
whole notices, listed and not, that the weights have not seen; below, the
paragraph is of an unknown licence. A named family stays only if enough of one
of its notices stands in the paragraph, where a term counts the more the fewer
families use it: "licensed under the" says nothing of which licence it is.

A paragraph is a line. Notices wrapped over several lines are looked for in
joins of neighbouring lines, which reach as many words beyond their first line
as the longest notice has.

A paragraph without any word that speaks for a licence cannot reach one: such
words are found from the weights, and the rest of the corpus is dropped by a
set lookup before anything else is computed. Frequent words are left out of the
lookup as long as all of them together could not outweigh "no licence".
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NONE, UNKNOWN = "none", "unknown"
#: Corpus paragraphs that serve as negative examples, at most.
SAMPLE_ROWS = 2000
#: Share of a notice's word pairs that must stand in a paragraph.
CONFIRMED = 0.6

# Published notices and phrases by which licences are granted.
NOTICES = {
    "agpl": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the GNU Affero General Public License.",
        "Licensed under the AGPL-3.0.",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License.",
        "Apache License Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
        "International License.",
    ],
    "cc0": [
        "Dedicated to the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation",
        "Licensed under the GNU General Public License.",
        "Licensed under the GPL-2.0.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License",
        "Licensed under the GNU Lesser General Public License.",
        "Released under the LGPL-3.0.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files",
        "Licensed under the MIT license.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
}
# Notices of licences that belong to no family above.
UNLISTED = [
    "Licensed under the Common Development and Distribution License, Version 1.0.",
    "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "Licensed under the Python Software Foundation License, Version 2.",
    "Released under the Microsoft Public License.",
    "Made available under the Open Database License 1.0.",
    "Released under the University of Illinois Open Source License.",
    "Licensed under the Academic Free License, Version 3.0.",
    "Licensed under the Open Software License, Version 3.0.",
    "Released under the PostgreSQL License.",
    "Released under the PHP License, version 3.01.",
    "Licensed under the Sleepycat License.",
    "Distributed under the CeCILL License, version 2.1.",
    "Licensed under the Apache Software License, Version 1.0.",
    "Licensed under the Netscape Public License, Version 1.1.",
    "This program is distributed under the terms of the Ruby License.",
    "This work is licensed under the Free Art License 1.3.",
    "SPDX-License-Identifier: CDDL-1.0",
    "SPDX-License-Identifier: OFL-1.1",
    "Licensed under the Open Government License, Version 3.0.",
    "Licensed under the IBM Public License, Version 1.0.",
    "Sleepycat License",
    "The PostgreSQL License",
    "Python Software Foundation License, Version 2",
    "Netscape Public License 1.1",
    "CeCILL Free Software License",
    "Ruby License",
    "PHP License",
    "Open Software License 3.0",
    "Academic Free License",
    "IBM Public License",
]
# Sentences with the words of licences that grant none.
NO_NOTICES = [
    "He renewed his driver license at the office of general public services.",
    "The license of the restaurant was released to the public yesterday.",
    "All rights reserved, no part of this work may be copied.",
    "Students of MIT and of the University of California met in Berkeley.",
    "The Apache helicopter is a version of an older aircraft.",
    "Mozilla and the free software movement are the subject of this article.",
    "The general said that the public is free to use this version.",
    "Creative people work in the commons under the international flag.",
    "Attribution of this work is not clear under the law.",
    "The terms and conditions of use are as follows.",
]


def words(text: Column | str) -> Column:
    """Lower-cased runs of letters, digits, dots, dashes and pluses inside words.

    Both spellings of licence are one.
    """
    lower = F.replace(F.lower(text), F.lit("licence"), F.lit("license"))
    parts = F.split(lower, r"[^\p{L}\p{N}.+-]++|[.+-]++(?![\p{L}\p{N}])")
    return F.array_remove(parts, "")


def terms(found: Column) -> Column:
    """Words and pairs of neighbouring words."""
    pairs = F.zip_with(
        F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0))),
        F.slice(found, 2, F.greatest(F.size(found) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.concat(found, pairs)


@dataclass
class Scanner:
    """The fitted model.

    ``triggers`` are the words one of which a licence needs; ``notices`` holds,
    for each family and notice, its terms and their weights.
    """

    vectorizer: CountVectorizerModel
    regression: LogisticRegressionModel
    families: list[str]
    triggers: list[str]
    notices: dict[str, list[list[tuple[str, float]]]]
    temperature: float
    sure: float


def _listed(spark: SparkSession) -> DataFrame:
    """``family, notice`` of everything written above."""
    listed = [(f, t) for f, texts in NOTICES.items() for t in texts]
    listed += [(UNKNOWN, t) for t in UNLISTED] + [(NONE, t) for t in NO_NOTICES]
    rows = [F.struct(F.lit(f).alias("family"), F.lit(t).alias("notice")) for f, t in listed]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _examples(spark: SparkSession) -> DataFrame:
    """``family, notice, text``: notices whole, and with any one word left out."""
    word = F.split("notice", " ")
    left_out = F.transform(
        F.sequence(F.lit(0), F.size(word) - 1),
        lambda k: F.array_join(F.filter(word, lambda w, i: i != k), " "),
    )
    several = F.concat(F.array("notice", "notice", "notice"), left_out)
    return _listed(spark).select("family", "notice", F.explode(several).alias("text"))


def _weighted_notices(spark: SparkSession) -> dict[str, list[list[tuple[str, float]]]]:
    """The terms of each family's notices, the rarer among families the heavier."""
    rows = _listed(spark).where(F.col("family").isin(list(NOTICES)))
    found = rows.select("family", F.array_distinct(terms(words("notice"))).alias("t")).collect()
    families: dict[str, set[str]] = {}
    for r in found:
        for term in r["t"]:
            families.setdefault(term, set()).add(r["family"])
    weight = {t: math.log((len(NOTICES) + 1) / len(f)) for t, f in families.items()}
    out: dict[str, list[list[tuple[str, float]]]] = {f: [] for f in NOTICES}
    for r in found:
        out[r["family"]].append([(t, weight[t]) for t in r["t"]])
    return out


def _paragraphs(docs: DataFrame, text_col: str) -> Column:
    return F.filter(F.split(F.col(text_col), r"[\n\x0B\f\r\x{85}\x{2028}\x{2029}]+"), lambda p: F.trim(p) != "")


def train(
    docs: DataFrame, *, key: list[str], text_col: str = "text", sample_rows: int = SAMPLE_ROWS
) -> Scanner:
    """Fits on the notices and on at most ``sample_rows`` corpus paragraphs.

    Those are paragraphs, one to a document, of the first documents by hash,
    without any that speaks of licences, copyright or permission; if there are
    none, the written sentences are the only negative examples.
    """
    spark = docs.sparkSession
    # The cut is found on the keys, so that only texts near it are looked at.
    slot = F.xxhash64(*key).alias("h")
    first = docs.select(slot).orderBy("h").limit(2 * sample_rows)
    cut = first.agg(F.max("h").alias("c")).first()["c"]
    near = docs.select(text_col, slot).where(F.col("h") <= F.lit(cut))
    plain = near.where(~F.lower(text_col).rlike("licen[cs]e|copyright|permission|spdx"))
    # One paragraph of a document, whichever its hash says.
    found = plain.select(_paragraphs(plain, text_col).alias("p"), "h").where(F.size("p") > 0)
    one = F.element_at("p", (F.pmod("h", F.size("p")) + 1).cast("int"))
    sample = found.select("h", one.alias("text")).orderBy("h", "text").limit(sample_rows)
    sample = sample.select(F.lit(NONE).alias("family"), F.col("text").alias("notice"), "text")
    rows = _examples(spark).unionByName(sample).withColumn("terms", terms(words("text")))
    families = [NONE, UNKNOWN, *NOTICES]
    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    # A notice is held out whole, with all that was made from it.
    held = F.pmod(F.xxhash64("family", "notice"), F.lit(4)) == 0
    rows = rows.select("terms", label.cast("double").alias("label"), held.alias("held")).cache()
    trial = _fitted(rows.where("NOT held"), families)
    temperature, sure = _calibrated(trial, rows.where("held"))
    scanner = _fitted(rows, families)
    scanner.temperature, scanner.sure = temperature, sure
    scanner.notices = _weighted_notices(spark)
    scanner.triggers = _triggers(scanner, rows.where("label = 0"))
    rows.unpersist()
    return scanner


def _fitted(rows: DataFrame, families: list[str]) -> Scanner:
    own = rows.coalesce(1)  # a bounded number of short rows
    # What is no term of a notice cannot speak for a licence.
    vectorizer = CountVectorizer(inputCol="terms", outputCol="features", binary=True).fit(
        own.where("label > 0")
    )
    regression = LogisticRegression(
        family="multinomial", regParam=0.002, elasticNetParam=0.8, maxIter=40
    ).fit(vectorizer.transform(own))
    return Scanner(vectorizer, regression, families, [], {}, 1.0, 0.5)


def _triggers(scanner: Scanner, plain: DataFrame) -> list[str]:
    """Words without which all licences are less likely than none.

    Of a pair either word would do, so the one that fewer plain paragraphs
    hold is taken. The most frequent words are left out as long as all terms
    so left out, taken together, speak less for the licences than the biases
    speak against them.
    """
    vocabulary = scanner.vectorizer.vocabulary
    matrix = scanner.regression.coefficientMatrix.toArray()
    bias = scanner.regression.interceptVector.toArray()
    gain = (matrix[1:] - matrix[0]).clip(min=0)  # only differences of weights count
    known = {w for term in vocabulary for w in term.split(" ")}
    word = plain.select(F.explode(F.array_distinct("terms")).alias("w"))
    counts = word.where(F.col("w").isin(sorted(known))).groupBy("w").count().collect()
    often = {r["w"]: r["count"] for r in counts}
    of_word: dict[str, list[int]] = {}
    for k, term in enumerate(vocabulary):
        if gain[:, k].max() > 1e-9:
            rare = min(term.split(" "), key=lambda w: (often.get(w, 0), -len(w), w))
            of_word.setdefault(rare, []).append(k)
    reached = bias[1:] - bias[0]
    if np.exp(reached).sum() >= 1:
        raise ValueError("a text without any known term would get a licence; add negative examples")
    kept = []
    for w in sorted(of_word, key=lambda w: (-often.get(w, 0), w)):
        more = reached + gain[:, of_word[w]].sum(axis=1)
        if often.get(w, 0) and np.exp(more).sum() < 1:
            reached = more
        else:
            kept.append(w)
    return sorted(kept)


def _logits(scanner: Scanner, rows: DataFrame) -> DataFrame:
    raw = scanner.regression.transform(scanner.vectorizer.transform(rows))
    return raw.withColumn("logits", vector_to_array("rawPrediction"))


def _calibrated(scanner: Scanner, held: DataFrame) -> tuple[float, float]:
    """Temperature with the least log loss, and the best floor for a family.

    The floor is the one that keeps most right families and drops most others,
    weighing both sides alike; ties go to the highest.
    """
    grid = [math.exp(x / 4) for x in range(-8, 9)]
    rows = _logits(scanner, held)
    y = F.element_at("logits", F.col("label").cast("int") + 1)

    def loss(t: float) -> Column:
        total = F.aggregate("logits", F.lit(0.0), lambda a, z: a + F.exp((z - y) / t))
        return F.avg(F.log(total))

    losses = [loss(t) for t in grid]
    found = rows.agg(*[x.alias(f"t{k}") for k, x in enumerate(losses)]).first()
    if found["t0"] is None:
        return 1.0, 0.5
    scanner.temperature = min(zip(found, grid))[1]
    named = rows.where("prediction > 1").withColumn("p", _probability(scanner))
    right = F.col("label") == F.col("prediction")
    floors = [k / 20 for k in range(10, 20)]
    kept = named.agg(
        *[F.avg(F.when(right, (F.col("p") >= f).cast("int"))).alias(f"r{f}") for f in floors],
        *[F.avg(F.when(~right, (F.col("p") < f).cast("int"))).alias(f"w{f}") for f in floors],
    ).first()
    score = {f: (kept[f"r{f}"] or 0.0) + (kept[f"w{f}"] or 0.0) for f in floors}
    return scanner.temperature, max(floors, key=lambda f: (score[f], f))


def _some_licence() -> Column:
    """Whether all licences together are likelier than none."""
    none = F.element_at("logits", 1)
    others = F.slice("logits", 2, F.size("logits"))
    return F.aggregate(others, F.lit(0.0), lambda a, z: a + F.exp(z - none)) > 1


def _probability(scanner: Scanner) -> Column:
    """Calibrated probability of the likeliest class but "none"."""
    top = F.array_max(F.slice("logits", 2, F.size("logits")))
    t = scanner.temperature
    return 1 / F.aggregate("logits", F.lit(0.0), lambda a, z: a + F.exp((z - top) / t))


def scan(docs: DataFrame, scanner: Scanner, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, paragraph, lines, text, family, probability, similarity``: what was found.

    A row for each paragraph (from 0; runs of line ends part them) that the
    model gives to a family or to unlisted licences. It is ``unknown`` then, or
    if the model is not sure or no notice of the family confirms it. A row of more ``lines`` is a notice that
    starts in that paragraph and goes on in the next ones, joined by blanks;
    it is there only for a family that is sure and confirmed, and holds more of
    its notice than with a line less at either end, and no less than with one
    more. Whole texts are scanned without a shuffle; null and empty texts, and
    texts of blanks, have no paragraphs. Repeated rows are scanned as often as
    they come; columns besides id and text are not read.
    """
    spark = docs.sparkSession
    hot = F.transform("p", lambda p: F.exists(words(p), lambda w: w.isin(scanner.triggers)))
    rows = docs.select(F.col(id_col).alias("id"), _paragraphs(docs, text_col).alias("p"))
    # One element exploded: the flags are computed once, not at each use.
    rows = rows.select("id", F.explode_outer(F.array(F.struct("p", hot.alias("hot")))).alias("d"))
    reach = _longest()
    place = F.when(
        F.array_contains("d.hot", True),
        F.filter(
            F.sequence(F.lit(0), F.size("d.hot") - 1),
            lambda i: F.array_contains(F.slice("d.hot", i + 1, reach + 1), True),
        ),
    )
    near = F.transform(
        place,
        lambda i: F.struct(
            i.alias("paragraph"),
            F.get("d.hot", i).alias("hot"),
            F.when(i > 0, F.get("d.p", i - 1)).otherwise("").alias("before"),
            F.slice("d.p", i + 1, reach + 2).alias("near"),
        ),
    )
    rows = rows.select("id", F.explode_outer(near).alias("s")).where("s IS NOT NULL").select("id", "s.*")
    # The lines whose first word is at most ``reach`` words behind the first line.
    none = F.struct(F.lit(0).alias("n"), F.lit(1).alias("lines"))
    most = F.aggregate(
        F.slice("near", 2, reach),
        none,
        lambda a, line: F.when(
            a["n"] < reach,
            F.struct((a["n"] + F.size(words(line))).alias("n"), (a["lines"] + 1).alias("lines")),
        ).otherwise(a),
        lambda a: a["lines"],
    )
    rows = rows.withColumn("most", most)
    # Less text has no more of a notice, so the longest join decides for all.
    rows = rows.withColumn("terms", terms(words(F.array_join(F.slice("near", 1, F.col("most")), " "))))
    rows = rows.join(F.broadcast(_notice_table(spark, scanner)), F.lit(ALL) == F.col("of"))
    every = _similarity(F.col("terms"))
    wide = (F.col("most") > 1) & F.when(F.col("most") > 1, every >= CONFIRMED)
    counts = F.sequence(F.lit(1), F.when(wide, F.col("most")).otherwise(1))
    counts = F.filter(counts, lambda k: (k > 1) | F.col("hot"))
    rows = rows.select("id", "paragraph", "before", "near", F.explode_outer(counts).alias("lines"))
    rows = rows.where("lines IS NOT NULL")
    # The optimiser may move the model before the filter: its terms are never null.
    text = F.coalesce(F.array_join(F.slice("near", 1, F.col("lines")), " "), F.lit(""))
    rows = rows.withColumn("text", text).withColumn("terms", terms(words("text")))
    named = _logits(scanner, rows).where(_some_licence())
    # The likeliest of the classes but "none".
    others = F.slice("logits", 2, len(scanner.families) - 1)
    family = F.element_at(
        F.array(*map(F.lit, scanner.families[1:])),
        F.array_position(others, F.array_max(others)).cast("int"),
    )
    named = named.select(
        "id", "paragraph", "lines", "text", "terms", "before", "near", family.alias("family"),
        _probability(scanner).alias("probability"),
    )
    own = F.broadcast(_notice_table(spark, scanner))  # a row a family
    named = named.join(own, F.col("family") == F.col("of"), "left")
    named = named.withColumn("similarity", _similarity(F.col("terms")))
    sure = (F.col("probability") >= scanner.sure) & (F.col("similarity") >= CONFIRMED)
    sure = sure & (F.col("family") != UNKNOWN)
    named = named.where((F.col("lines") == 1) | sure)

    def joined(start, n) -> Column:
        return F.array_join(F.slice("near", start, n), " ")

    lines = F.col("lines")
    less = [joined(2, lines - 1), joined(1, lines - 1)]
    more = [joined(1, lines + 1), F.concat_ws(" ", "before", "text")]
    best = reduce(
        Column.__and__,
        [F.col("similarity") > _similarity(terms(words(t))) for t in less]
        + [F.col("similarity") >= _similarity(terms(words(t))) for t in more],
    )
    named = named.where(F.when(lines == 1, True).otherwise(best))
    return named.select(
        F.col("id").alias(id_col), "paragraph", "lines", "text",
        F.when(sure, F.col("family")).otherwise(UNKNOWN).alias("family"),
        "probability", "similarity",
    )


def _longest() -> int:
    """Words of the longest notice; each word may stand in a line of its own."""
    return max(len(notice.split()) for notices in NOTICES.values() for notice in notices)


#: The row of all families' notices together.
ALL = "*"


def _notice_table(spark: SparkSession, scanner: Scanner) -> DataFrame:
    """``of, notices``: each family's weighted terms, and those of all; fixed rows."""
    rows = [{"of": f, "notices": n} for f, n in scanner.notices.items()]
    rows.append({"of": ALL, "notices": [x for n in scanner.notices.values() for x in n]})
    for row in rows:
        row["notices"] = [[{"t": t, "w": w} for t, w in notice] for notice in row["notices"]]
    kind = "array<struct<of: string, notices: array<array<struct<t: string, w: double>>>>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), kind)))


def _similarity(found: Column) -> Column:
    """The largest share of one of the row's ``notices`` that is among ``found``.

    Without notices it is 0. ``found`` is computed once for all of them.
    """

    def weight(notice: Column) -> Column:
        return F.aggregate(notice, F.lit(0.0), lambda a, x: a + x["w"])

    def best(own: Column) -> Column:
        shares = F.transform(
            "notices",
            lambda n: weight(F.filter(n, lambda x: F.array_contains(own, x["t"]))) / weight(n),
        )
        return F.coalesce(F.array_max(shares), F.lit(0.0))

    return F.element_at(F.transform(F.array(found), best), 1)


def by_document(
    docs: DataFrame, scanner: Scanner, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, n_paragraphs, n_found, n_unknown, licences, probability`` of each id.

    ``licences`` are the families found, sorted and comma-joined; the
    probability is the largest. Rows with one id count as one document. A
    paragraph in a notice of several lines does not count by itself if it is of
    the same family or unknown.
    """
    text = F.xxhash64(text_col).alias("of")
    found = scan(docs.select(F.struct(id_col, text).alias("key"), text_col), scanner, id_col="key", text_col=text_col)
    # Rows of one text only, as paragraphs are numbered in it.
    rows = F.collect_list(F.struct("paragraph", "lines", "family", "probability"))
    found = found.groupBy("key").agg(rows.alias("r"))
    alone = F.filter(
        "r",
        lambda a: (a["lines"] > 1)
        | ~F.exists(
            F.filter("r", lambda b: b["lines"] > 1),
            lambda b: a["paragraph"].between(b["paragraph"], b["paragraph"] + b["lines"] - 1)
            & a["family"].isin(b["family"], UNKNOWN),
        ),
    )
    found = found.select(F.col(f"key.{id_col}").alias(id_col), F.inline(alone))
    known = F.col("family") != UNKNOWN
    found = found.groupBy(F.col(id_col).alias("id")).agg(
        F.count("*").alias("n_found"),
        F.count_if(~known).alias("n_unknown"),
        F.array_join(F.array_sort(F.collect_set(F.when(known, F.col("family")))), ",").alias("licences"),
        F.max("probability").alias("probability"),
    )
    n = F.coalesce(F.size(_paragraphs(docs, text_col)), F.lit(0))
    n = F.when(F.col(text_col).isNull(), 0).otherwise(n).cast("bigint")
    every = docs.groupBy(F.col(id_col).alias("own")).agg(F.sum(n).alias("n_paragraphs"))
    return every.join(found, F.col("own").eqNullSafe(F.col("id")), "left").select(
        F.col("own").alias(id_col), "n_paragraphs",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_found", "n_unknown")],
        F.coalesce("licences", F.lit("")).alias("licences"),
        F.coalesce("probability", F.lit(0.0)).alias("probability"),
    )
