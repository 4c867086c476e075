r"""Licence scans: a trained paragraph classifier over sparse word n-grams, confirmed by templates.

A paragraph is what stands between blank lines, its lines joined by a space; each of its lines is a
candidate besides. Where several licences are named one after another, as in "under A or B", each name with what leads to it is
one too; what a sentence denies is taken out before. A candidate's features are its distinct word 1- and 2-grams. A multinomial logistic
regression, trained here on the driver from the notices below (a fixed, small set), gives each
licence family and the class ``unknown`` a weight per n-gram; a temperature calibrates the
probabilities, fitted on notices in frames and on other sentences that the fit has not seen. A
prediction counts when the paragraph also covers enough of the n-grams of one of the family's
templates, and of those that no other family has.

At run time only DataFrame functions run: each distinct candidate is scored once, by a join with the
weight table, which is as large as the notices make it; what is confirmed is joined back. Candidates
are the lines and paragraphs that hold a word of :func:`gate_words`. These words come from the
templates: without any of them no template can be covered, so nothing is lost.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import MOST_BROADCAST, cut, dealt_join, documents, text_or_empty

#: Names by which each family is called in notices, and sentences of its own.
FAMILIES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "apache-2.0": (
        ("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "Apache 2.0 license"),
        ("You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "you may not use this file except in compliance with the License"),
    ),
    "mit": (
        ("MIT License", "The MIT Licence", "MIT", "Expat License"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ),
    "gpl-2.0": (("GNU General Public License, version 2", "GPLv2", "GPL-2.0-only", "GPL-2.0-or-later", "GNU GPL version 2"), ()),
    "gpl-3.0": (
        ("GNU General Public License, version 3", "GPLv3", "GPL-3.0-only", "GPL-3.0-or-later", "GNU GPL version 3", "GNU General Public License v3.0"),
        ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",),
    ),
    "gpl": (("GNU General Public License", "GNU GPL"), ()),
    "lgpl": (("GNU Lesser General Public License", "LGPL", "LGPL-2.1", "LGPL-3.0", "GNU Lesser General Public License, version 2.1"), ()),
    "agpl-3.0": (("GNU Affero General Public License", "AGPL-3.0", "AGPLv3", "GNU Affero General Public License, version 3"), ()),
    "bsd": (
        ("BSD 3-Clause License", "BSD 2-Clause License", "BSD license", "BSD-3-Clause", "BSD-2-Clause", "BSD 4-Clause License", "BSD-4-Clause"),
        (
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
        ),
    ),
    "mpl-2.0": (("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0", "MPL 2.0"), ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",)),
    "cc-by": (("CC BY 4.0", "CC-BY-4.0", "Creative Commons Attribution 4.0", "Creative Commons Attribution 4.0 International License"), ()),
    "cc-by-sa": (("CC BY-SA 4.0", "CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"), ()),
    "cc-by-nc": (("CC BY-NC 4.0", "CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"), ()),
    "cc-by-nc-sa": (("CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"), ()),
    "cc0": (("CC0 1.0", "CC0", "CC0 1.0 Universal", "Creative Commons Zero"), ("dedicated to the public domain under CC0",)),
    "isc": (("ISC License",), ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",)),
    "epl-2.0": (("Eclipse Public License 2.0", "Eclipse Public License, version 2.0", "EPL-2.0"), ()),
    "boost": (("Boost Software License 1.0", "Boost Software License, Version 1.0", "BSL-1.0"), ()),
    "unlicense": (("The Unlicense", "Unlicense"), ("This is free and unencumbered software released into the public domain",)),
    "wtfpl": (("WTFPL", "Do What The Fuck You Want To Public License"), ()),
    "proprietary": ((), ("All rights reserved.", "Copyright. All rights reserved. No part may be reproduced without written permission", "Confidential and proprietary, unauthorized copying is prohibited")),
}
FRAMES = ("Licensed under the {}.", "Licensed under {}.", "Released under the {}.", "This work is licensed under the {}.", "This project is distributed under the terms of the {}", "SPDX-License-Identifier: {}", "License: {}", "The code is available under the {} license.", "See LICENSE for the {}.", "{}")
OTHER = (
    "The driver showed a licence at the border.", "He got his driving license last year.", "A license fee is due each month.", "The poetic licence of the author is plain.",
    "The software licence was discussed at length.", "License plates are checked here.", "They asked for permission to leave.", "The warranty covers two years.",
    "Mit der Bahn kommt man weiter.", "mit dem und der die das", "Der Fahrer kam mit einer Lizenz zu uns.", "Apache helicopters flew over the town.", "The apache tribe lived there.", "Version 3 of the plan was better than version 2.",
    "The general public was invited.", "The public may use the library.", "Creative people meet in the commons.", "A copy of the letter is attached.", "copyright law is old", "They were licensed to sell fish.",
    "the terms of the treaty", "This work is hard.", "released under pressure", "under the bridge", "The GNU is a large antelope.", "a source of income", "foundation of the house",
)
#: Identifiers that are words of their own besides; a frame has to lead to them.
SHORT = {"MIT": "mit", "ISC": "isc", "GPL": "gpl"}
#: A family without a version, and those with one.
VERSIONS = {"gpl": ("gpl-2.0", "gpl-3.0")}
#: Sentences about a licence that give none.
TALK = ("The {} fee is due.", "They talked about the {} at length.", "A course on the {} begins today.", "He compared the {} with the others.", "Is the {} a good one?", "The history of the {} is long.")
#: Words that tell little wherever they stand.
FREQUENT = ("are", "as", "be", "do", "from", "in", "is", "it", "may", "no", "not", "that", "to", "under", "v", "above", "all", "can", "either", "file", "form", "into", "part", "person", "shall", "what", "written", "you", "and", "any", "available", "by", "charge", "copies", "except", "following", "free", "general", "hereby", "included", "notice", "of", "only", "or", "later", "nc", "program", "public", "published", "sa", "the", "this", "want", "with", "without")
WORDS = r"[a-z0-9]+"
#: What leads to the names of several licences in a sentence, how a name begins, and what stands between them.
LEAD = r"(?i)^(.*?(?:\b(?:licensed|released|available|distributed|offered)\b[^.]*?\bunder(?:\s+the)?(?:\s+terms\s+of)?(?:\s+(?:either|both))?(?:\s+the)?|license-identifier:|licen[sc]es?:))\s+([^.]*+(?:[.]\S[^.]*+){0,40})"
NAME = r"^[\s(]*(?:the\s+)?[A-Z0-9]"
BETWEEN = r"(?i)[\s)]+(?:and|or)[\s(]+(?:the\s+)?|\s*[/|&;]\s*|,\s*(?!\s*v(?:ersion|\.)?\s*\d)"
#: A denial, to the end of its sentence.
DENIED = r"(?i)\b(?:not|never|no\s+longer)\s+(?:\w+\s+){0,2}(?:licensed|released|distributed|available|offered)\b[^.;!?]*+(?:[.]\S[^.;!?]*+){0,40}"
UNKNOWN = "unknown"
#: A bare reservation of rights also opens many open licences; with these words it is more than that.
RESERVED, CLOSED = r"(?i)rights\s+reserved", r"(?i)confidential|proprietary|unauthorized|no part|written permission"
EPOCHS, RATE, PENALTY = 300, 0.5, 2e-4
#: Least share of a template's n-grams that the paragraph has to hold, of those that no other family has, and least probability.
#: One frame in so many, and one other sentence, is kept for the calibration.
COVERAGE, OWN, LEAST, KEPT = 0.7, 0.5, 0.5, 4


def _words(text: str) -> list[str]:
    import re

    return re.findall(WORDS, text.lower())


def _ngrams(text: str) -> set[str]:
    words = _words(text)
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))}


def _notices() -> list[tuple[str, str, float, bool]]:
    """Text, class, weight in the fit, and whether it is kept for the calibration: whole frames, and whole sentences."""
    names = [(n, k) for k, (given, _) in FAMILIES.items() for n in (*given, *(x for x, family in SHORT.items() if family == k and x not in given))]
    rows = [(f.format(n), k, 3.0 if f == "{}" else 1.0, i % KEPT == KEPT - 1) for n, k in names for i, f in enumerate(FRAMES) if n not in SHORT or f != "{}"]
    rows += [(s, k, 6.0, False) for k, (_, own) in FAMILIES.items() for s in own]
    rows += [(f.format(n), UNKNOWN, 0.5, i % KEPT == KEPT - 1) for n, _ in names for i, f in enumerate(TALK)]
    return rows + [(s, UNKNOWN, 4.0, i % KEPT == KEPT - 1) for i, s in enumerate(OTHER)]


@lru_cache(maxsize=1)
def model() -> tuple[list[str], dict[str, np.ndarray], np.ndarray]:
    """Class names, a weight vector per n-gram, and the intercepts; temperature already divided out."""
    rows, names = _notices(), [*FAMILIES, UNKNOWN]
    vocabulary = {g: i for i, g in enumerate(sorted(set().union(*(_ngrams(t) for t, _, _, _ in rows))))}
    x, y = np.zeros((len(rows), len(vocabulary))), np.array([names.index(k) for _, k, _, _ in rows])
    for i, (t, _, _, _) in enumerate(rows):
        x[i, [vocabulary[g] for g in _ngrams(t)]] = 1
    weight, held = np.array([w for _, _, w, _ in rows]), np.array([kept for _, _, _, kept in rows])
    hot = np.eye(len(names))[y]

    def fit(rows_in: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w, b = np.zeros((len(vocabulary), len(names))), np.zeros(len(names))
        own, by = x[rows_in], (weight[rows_in] / weight[rows_in].sum())[:, None]
        for _ in range(EPOCHS):
            z = own @ w + b
            p = np.exp(z - z.max(1, keepdims=True))
            g = (p / p.sum(1, keepdims=True) - hot[rows_in]) * by
            w -= RATE * 10 * (own.T @ g + PENALTY * w)
            b -= RATE * 10 * g.sum(0)
        return w, b

    w, b = fit(~held)
    z = x[held] @ w + b

    def loss(t: float) -> float:
        q = z / t
        q = q - q.max(1, keepdims=True)
        return float(-(q - np.log(np.exp(q).sum(1, keepdims=True)))[np.arange(len(q)), y[held]].mean())

    heat = min((0.3, 0.4, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=loss)
    w, b = fit(np.ones(len(rows), bool))
    return names, {g: w[i] / heat for g, i in vocabulary.items()}, b / heat


@lru_cache(maxsize=1)
def templates() -> list[tuple[str, frozenset[str], frozenset[str]]]:
    """Families with the n-grams of their names and sentences, and those of them that no other family has.

    A short identifier is confirmed by the words of a frame that lead to it: all pairs of the last four.
    """
    held = [(k, _ngrams(t)) for k, (names, own) in FAMILIES.items() for t in (*names, *own) if t not in SHORT]
    for short, family in SHORT.items():
        for frame in FRAMES:
            words = _words(frame.format(short))
            lead = words[: words.index(short.lower()) + 1][-4:]
            if len(lead) > 1:
                held.append((family, {f"{a} {b}" for a, b in zip(lead, lead[1:], strict=False)}))
    others = {k: set().union(*(t for name, t in held if name != k)) for k, _ in held}
    return [(k, frozenset(t), frozenset(t - others[k])) for k, t in held]


@lru_cache(maxsize=1)
def gate_words() -> tuple[str, ...]:
    """Words, and pairs of words, of which every paragraph that covers a template holds one.

    Taking the n-grams with these away leaves too few of each template, of all its n-grams or of its
    own. A template with few of its own goes by these; of the others the words that are not common are
    taken first, and of these those with the most letters.
    """
    chosen: set[str] = {"license", "licence", "licensed"}
    common = {*FREQUENT, *(w for t in (*OTHER, *TALK, *FRAMES) for w in _words(t))}
    for _, grams, own in sorted(templates(), key=lambda t: (len(t[1]), sorted(t[1]))):
        words = sorted({w for g in grams for w in g.split()}, key=lambda w: (not w[:1].isalpha(), w in common, -sum(c.isalpha() for c in w), w))
        rare = [w for w in words if w[:1].isalpha() and w not in common]
        items = [*(sorted(own) if len(own) <= 2 else ()), *rare, *sorted((g for g in own if " " in g), key=lambda g: (-len(g), g)), *words]
        without = lambda part: [g for g in part if g not in chosen and not chosen & set(g.split())]
        while len(without(grams)) >= COVERAGE * len(grams) and len(without(own)) >= OWN * len(own):
            chosen.add(next(w for w in items if w not in chosen))
    return tuple(sorted(chosen))


def _gate() -> str:
    return rf"(?i)(?<![a-z0-9])(?:{'|'.join(g.replace(' ', '[^a-z0-9]+') for g in gate_words())})(?![a-z0-9])"


def _weights(spark: SparkSession) -> DataFrame:
    """One row per n-gram of the notices: its weights, and the templates that hold it, as their own or at all."""
    names, weights, _ = model()
    held = templates()
    schema = ", ".join(["gram string", *(f"w{i} double" for i in range(len(names))), "held array<int>", "own array<int>"])
    return spark.createDataFrame([(g, *map(float, v), [j for j, t in enumerate(held) if g in t[1]], [j for j, t in enumerate(held) if g in t[2]]) for g, v in weights.items()], schema)


def _classified(paragraphs: DataFrame, carried: list[str]) -> DataFrame:
    """``carried`` (which begins with a key) of rows with a ``paragraph``, with family, probability, p_unknown, coverage and confirmed.

    Only keys and the n-grams that the notices know leave the row; a paragraph may be a whole document.
    """
    names, weights, intercept = model()
    held = templates()
    words = F.regexp_extract_all(F.lower("paragraph"), F.lit(WORDS), F.lit(0))
    pairs = F.zip_with(F.slice("_words", F.lit(1), F.greatest(F.size("_words") - 1, F.lit(0))), F.slice("_words", F.lit(2), F.greatest(F.size("_words") - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    known = F.array_intersect(F.concat("_words", pairs), F.array(*map(F.lit, sorted(weights))))
    grams = paragraphs.select(*carried, words.alias("_words")).select(*carried, F.explode_outer(known).alias("gram"))
    none = F.array().cast("array<int>")
    sums = (
        grams.join(F.broadcast(_weights(paragraphs.sparkSession)), "gram", "left")
        .groupBy(*carried)
        .agg(*[F.coalesce(F.sum(f"w{i}"), F.lit(0.0)).alias(f"w{i}") for i in range(len(names))], F.flatten(F.collect_list(F.coalesce("held", none))).alias("_held"), F.flatten(F.collect_list(F.coalesce("own", none))).alias("_own"))
    )
    logits = [F.col(f"w{i}") + float(intercept[i]) for i in range(len(names))]
    times = lambda c, j: F.size(F.filter(c, lambda x: x == j))
    share = F.array(*[F.when(times("_own", j) >= OWN * len(own), times("_held", j) / len(t)).otherwise(0.0) for j, (_, t, own) in enumerate(held)])
    sums = sums.select(*carried, F.array(*logits).alias("_z"), share.alias("_share"))
    top = F.array_max("_z")
    total = F.aggregate(F.transform("_z", lambda z: F.exp(z - top)), F.lit(0.0), lambda a, b: a + b)
    best = F.array_position("_z", top).cast("int") - 1
    family = F.get(F.array(*map(F.lit, names)), best)
    of = F.array(*[F.lit(k) for k, _, _ in held])
    return sums.select(
        *carried,
        family.alias("family"),
        (F.lit(1.0) / total).alias("probability"),
        (F.exp(F.get("_z", len(names) - 1) - top) / total).alias("p_unknown"),
        F.coalesce(F.array_max(F.zip_with("_share", of, lambda x, k: F.when(k == family, x))), F.lit(0.0)).alias("coverage"),
    ).withColumn("confirmed", (F.col("family") != UNKNOWN) & (F.col("probability") >= LEAST) & (F.col("coverage") >= COVERAGE))


def classify_paragraphs(paragraphs: DataFrame, col: str = "paragraph") -> DataFrame:
    """Per distinct paragraph: family, probability, p_unknown, coverage, confirmed.

    coverage is the greatest of the family's templates of whose own n-grams enough are there.
    """
    rows = paragraphs.select(F.md5(col).alias("_key"), F.col(col).alias("paragraph")).groupBy("_key").agg(F.first("paragraph").alias("paragraph"))
    return rows.join(_classified(rows, ["_key"]), "_key").drop("_key").withColumnRenamed("paragraph", col)


def clauses(said: Column) -> Column:
    """What leads to several names together with each of them: an array, empty where there are not several."""
    lead = F.regexp_extract(said, LEAD, 1)
    parts = F.filter(F.split(F.regexp_extract(said, LEAD, 2), BETWEEN), lambda p: p.rlike(NAME))
    each = F.transform(parts, lambda p: F.concat(lead, F.lit(" "), p))
    return F.when((lead != "") & (F.size(parts) > 1), each).otherwise(F.array().cast("array<string>"))


def candidates(text: Column) -> Column:
    """The lines, and the paragraphs of several lines, that hold a gate word, without what they deny, and the clauses of either; as structs of paragraph and ``line``, whether it is one line."""
    gate = _gate()
    blocks = F.split(text, r"\r?\n(?:[\x20\x09-\x0D]*\n)+")
    joined = F.transform(F.filter(blocks, lambda b: F.trim(b).contains("\n")), lambda b: F.struct(F.regexp_replace(F.trim(b), r"[\x20\x09-\x0D]*\n[\x20\x09-\x0D]*", " ").alias("paragraph"), F.lit(False).alias("line")))
    lines = F.transform(F.split(text, r"\n+"), lambda p: F.struct(p.alias("paragraph"), F.lit(True).alias("line")))
    stated = lambda x: F.struct(F.regexp_replace(x["paragraph"], DENIED, " ").alias("paragraph"), x["line"].alias("line"))
    held = F.transform(F.filter(F.concat(lines, joined), lambda x: x["paragraph"].rlike(gate)), stated)
    several = F.flatten(F.transform(held, lambda x: F.transform(clauses(x["paragraph"]), lambda c: F.struct(c.alias("paragraph"), F.lit(False).alias("line")))))
    held = F.concat(held, F.filter(several, lambda x: x["paragraph"].rlike(gate)))
    return F.when(text.rlike(gate), held).otherwise(F.array().cast("array<struct<paragraph:string,line:boolean>>"))


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per id: licenses (confirmed families, sorted, comma-joined), n_paragraphs, n_confirmed, score.

    n_paragraphs counts the lines with a gate word, n_confirmed the confirmed lines, paragraphs of
    several lines and clauses of either, score is the highest probability of a confirmed family (0 without one). A bare
    "All rights reserved" is proprietary only where no other family is confirmed, and a GPL without a version is one only
    where none with a version is. Null and empty texts
    have none; texts of any length are read whole. Rows that share an id, null included, share one
    result row. Other columns play no part, whatever their names. An empty table gives an empty result.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), F.explode_outer(candidates(text_or_empty(text_col))).alias("_found"))
    rows = rows.select("_id", F.col("_found.paragraph").alias("paragraph"), F.col("_found.line").alias("line"))
    # Tasks keep one of each line that they hold, so a line that stands in very many documents is one row of each.
    once = rows.filter(F.col("paragraph").isNotNull()).groupBy(F.md5("paragraph").alias("_key")).agg(F.first("paragraph").alias("paragraph"))
    bare = F.col("paragraph").rlike(RESERVED) & ~F.col("paragraph").rlike(CLOSED)
    found = _classified(once.withColumn("_bare", bare), ["_key", "_bare"]).filter("confirmed")
    sure = cut(found.select("_key", "family", "probability", ((F.col("family") == "proprietary") & F.col("_bare")).alias("bare")))
    keyed = rows.select("_id", "line", F.md5("paragraph").alias("_key"))
    if sure.count() <= MOST_BROADCAST:
        rows = keyed.join(F.broadcast(sure), "_key", "left")
    else:
        rows = dealt_join(keyed.filter(F.col("_key").isNotNull()), sure, "_key", "left").unionByName(keyed.filter(F.col("_key").isNull()), allowMissingColumns=True)
    plain, kept = F.col("family").isNotNull() & ~F.col("bare"), F.col("family").isNotNull() & F.col("bare")
    none = F.count(F.when(plain, F.lit(1))) == 0
    families = F.collect_set(F.when(plain, F.col("family")))
    # A name without a version, as in a line of a wrapped notice, says no more than those with one.
    families = F.when(F.arrays_overlap(families, F.array(*map(F.lit, VERSIONS["gpl"]))), F.array_remove(families, "gpl")).otherwise(families)
    return rows.groupBy(F.col("_id").alias(id_col)).agg(
        F.array_join(F.array_sort(F.when(none, F.collect_set(F.when(kept, F.col("family")))).otherwise(families)), ",").alias("licenses"),
        F.count(F.when(F.col("line"), F.lit(1))).alias("n_paragraphs"),
        F.when(none, F.count(F.when(kept, F.lit(1)))).otherwise(F.count(F.when(plain, F.lit(1)))).alias("n_confirmed"),
        F.coalesce(F.when(none, F.max(F.when(kept, F.col("probability")))).otherwise(F.max(F.when(plain, F.col("probability")))), F.lit(0.0)).alias("score"),
    )


def op9_licenses(spark, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))


QUERIES = {"op9_licenses": op9_licenses}
SQL: dict[str, str] = {}
