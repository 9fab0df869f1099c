"""Licence scans: which licence does a paragraph state?

A sparse multinomial logistic regression on word n-grams names the family of a paragraph, or `unknown`; a temperature
fitted on examples kept aside makes its probabilities honest. A comparison with the texts of the family confirms it: a
large part of one template's n-grams must be in the paragraph. Training needs no labels from the data, only the
templates, shortened, padded and mixed at random, and sentences that talk about licences without granting one.

The weights belong to the n-grams of the templates. Their number depends on the templates alone, so broadcasting them
is safe. Scoring is DataFrame functions throughout: paragraphs with a word that licences use or that a confirmed one
needs, their n-grams, one join, one grouped sum.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import groupby

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from otelier.functions.expressions import let

#: How licences name themselves and what their notices say.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.", "Licensed under the MIT license.", "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS"),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program."),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License"),
    "BSD": (
        "Licensed under the BSD 3-Clause License.", "Released under the 2-clause BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following  are met",
        "Redistributions of source code must retain the above copyright notice, this list of  and the following disclaimer."),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "CC-BY": (
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0": (
        "Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    "Proprietary": (
        "All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential."),
}
OTHER = (
    "She lost her driver's license on the way to the city", "The restaurant applied for a liquor license last year",
    "The software comes with a warranty of two years", "You need permission from your parents", "The court heard a copyright dispute between two bands",
    "A pilot must renew the licence every two years", "The public library offers free copies of the map", "All rights of the tenant are explained in the contract",
    "The university granted her permission to use the source", "Terms and  of the sale apply", "Version 2 of the program was released in May",
    "The general public was not admitted", "Fishing is permitted with a license", "The apache helicopter landed near the foundation",
    "He is a licensed electrician", "Creative people work in common rooms", "Copies of the notice were distributed", "The attribution of the painting is disputed",
)
UNKNOWN = "unknown"
FAMILIES = (UNKNOWN, *TEMPLATES)
#: Words of an n-gram at most.
GRAM = 3
#: Examples made from each template.
EXAMPLES = 30
#: A family needs this probability, and this share of one template's n-grams.
PROBABILITY, CONTAINMENT = 0.5, 0.5
#: Words that licences use; a paragraph with one gives a row, confirmed or not.
ANCHORS = r"(?i)licen[sc]e|copyright|permission|redistribut|public license|rights reserved|unauthorized copying|source code form|CC0|apply|warranted|software distributed"
#: Words too frequent to look for first. The choice costs or saves time only.
_EVERYDAY = frozenset("a all an and any are as at be by can for from have in included is it may no not of on or "
                      "that the this to under use with work you your 0 1 2 3 4".split())

_WORD = r"[\p{L}\p{N}]+"


def words(text: str) -> list[str]:
    return [w.lower() for w in re.findall(r"[^\W_]+", text)]


def grams(tokens: list[str]) -> set[str]:
    return {" ".join(tokens[i:i + n]) for n in range(1, GRAM + 1) for i in range(len(tokens) - n + 1)}


def needed_words(template: str) -> set[str]:
    """Words of which every paragraph that holds CONTAINMENT of a template's n-grams has at least one.

    Words are added, those that are in most n-grams first, until the n-grams without any of them are too few to confirm.
    """
    left, whole, needed = (held := grams(words(template))), len(held), set()
    while len(left) >= CONTAINMENT * whole:
        counts = {w: sum(w in g.split(" ") for g in left) for w in {w for g in left for w in g.split(" ")}}
        needed.add(best := min(counts, key=lambda w: (w in _EVERYDAY, -counts[w], w)))
        left = {g for g in left if best not in g.split(" ")}
    return needed


def _confirmable() -> str:
    """A pattern that every lower-case text finds which a template can confirm."""
    needed = sorted(set().union(*(needed_words(t) for ts in TEMPLATES.values() for t in ts)))
    by_letter = "|".join(f"{c}(?:{'|'.join(w[1:] for w in ws)})" for c, ws in groupby(needed, lambda w: w[0]))
    return r"(?<![\p{L}\p{N}])(?:" + by_letter + r")(?![\p{L}\p{N}])"


def _examples(rng: np.random.Generator) -> tuple[list[list[str]], list[int]]:
    """Templates as found in the wild, and texts made of the same words that aren't licences."""
    prose = [w for s in OTHER for w in words(s)]
    pool = [w for ts in TEMPLATES.values() for t in ts for w in words(t)]
    texts, labels = [], []
    for label, family in enumerate(FAMILIES[1:], 1):
        for template in TEMPLATES[family]:
            base = words(template)
            for i in range(EXAMPLES):
                kept = [w for w in base if i < 5 or rng.random() > 0.08]
                texts.append([*rng.choice(prose, rng.integers(0, 12)), *kept, *rng.choice(prose, rng.integers(0, 12))])
                labels.append(label)
    for _ in range(len(texts)):
        kind = rng.random()
        if kind < 0.3:
            made = words(OTHER[rng.integers(len(OTHER))])
        elif kind < 0.6:
            made = list(rng.choice(prose, rng.integers(3, 40)))
        else:
            made = [*rng.choice(pool, rng.integers(1, 12)), *rng.choice(prose, rng.integers(1, 12))]
        texts.append(list(made))
        labels.append(0)
    return texts, labels


@dataclass(frozen=True)
class LicenceModel:
    """Weights per n-gram and family, biases, and the temperature that calibrates the probabilities."""

    vocabulary: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def probabilities(self, tokens: list[str]) -> np.ndarray:
        found = grams(tokens)
        z = (self.bias + sum((w for g, w in zip(self.vocabulary, self.weights) if g in found), np.zeros(len(FAMILIES)))) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()


def train(seed: int = 7, rounds: int = 250, rate: float = 2.0, sparsity: float = 2e-4) -> LicenceModel:
    """Proximal gradient descent: weights of n-grams that don't help become exactly 0."""
    rng = np.random.default_rng(seed)
    vocabulary = tuple(sorted({g for ts in TEMPLATES.values() for t in ts for g in grams(words(t))}))
    index = {g: i for i, g in enumerate(vocabulary)}

    def matrix(texts: list[list[str]]) -> np.ndarray:
        x = np.zeros((len(texts), len(vocabulary)), dtype=np.float32)
        for row, tokens in enumerate(texts):
            x[row, [index[g] for g in grams(tokens) if g in index]] = 1
        return x

    texts, labels = _examples(rng)
    aside = rng.random(len(texts)) < 0.2
    x, y = matrix(texts), np.array(labels)
    train_x, target = x[~aside], np.eye(len(FAMILIES), dtype=np.float32)[y[~aside]]
    w, bias = np.zeros((len(vocabulary), len(FAMILIES)), dtype=np.float32), np.zeros(len(FAMILIES), dtype=np.float32)
    for _ in range(rounds):
        z = train_x @ w + bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        error = (p - target) / len(target)
        w -= rate * (train_x.T @ error)
        bias -= rate * error.sum(0)
        w = np.sign(w) * np.maximum(np.abs(w) - rate * sparsity, 0)
    z = x[aside] @ w + bias

    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(1, keepdims=True)
        return float(-(s[np.arange(len(s)), y[aside]] - np.log(np.exp(s).sum(1))).mean())

    temperature = min((0.25 * 1.15 ** i for i in range(25)), key=loss)
    return LicenceModel(vocabulary, w.astype(float), bias.astype(float), float(temperature))


def _tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _grams(tokens: Column) -> Column:
    def parts(t: Column) -> Column:
        # words are fetched by place: a slice, or the tokens themselves in a lambda, would cost the whole line per word
        longer = [F.transform(F.when(F.size(t) >= n, F.sequence(F.lit(0), F.size(t) - n)).otherwise(F.array().cast("array<int>")),
                              lambda i: F.concat_ws(" ", *[F.get(t, i + j) for j in range(n)])) for n in range(2, GRAM + 1)]  # noqa: B023
        return F.concat(t, *longer)

    return let(tokens, parts)


def _weights(spark: SparkSession, model: LicenceModel) -> tuple[DataFrame, list[tuple[str, int]]]:
    """(gram, w: weight per family, t: numbers of the templates that hold it) and (family, n-grams) of each template."""
    templates = [(f, grams(words(t))) for f, ts in TEMPLATES.items() for t in ts]
    rows = [(g, w.tolist(), [i for i, (_, held) in enumerate(templates) if g in held]) for g, w in zip(model.vocabulary, model.weights)]
    return spark.createDataFrame(rows, "gram string, w array<double>, t array<int>"), [(f, len(held)) for f, held in templates]


def scan_licenses(docs: DataFrame, model: LicenceModel | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, paragraph, family, probability, template, containment, confirmed) for every paragraph (line, counted from 0)
    with a word that licences use or with CONTAINMENT of a template's n-grams.

    `family` is the most probable one where it has enough probability and a template of it confirms it, else `unknown`.
    `template` is the number of the best template of the most probable family and `containment` the share of its n-grams that is there. Null and
    empty texts and texts without such paragraphs give no rows. A null key stays null; repeated rows give repeated
    rows; other columns are left out; an empty table gives no rows.
    """
    model = model or train()
    table, templates = _weights(docs.sparkSession, model)
    told = lambda c: c.rlike(ANCHORS) | F.lower(c).rlike(_confirmable())
    rows = docs.where(told(F.col(text))).select(F.col(key).alias("k"), F.monotonically_increasing_id().alias("row"), F.posexplode(F.split(text, "\n", -1)).alias("paragraph", "line"))
    rows = rows.where(told(F.col("line"))).select("k", "row", "paragraph", F.col("line").rlike(ANCHORS).alias("anchored"), F.explode_outer(F.array_intersect(_grams(_tokens(F.col("line"))), F.lit(list(model.vocabulary)))).alias("gram"))
    # an outer explode and a left join keep paragraphs without any known n-gram; the table's size is that of the templates
    joined = rows.join(F.broadcast(table), "gram", "left")
    n = len(FAMILIES)
    sums = [F.sum(F.coalesce(F.col("w")[i], F.lit(0.0))).alias(f"z{i}") for i in range(n)]
    hits = [F.count_if(F.array_contains("t", i)).alias(f"t{i}") for i in range(len(templates))]
    scored = joined.groupBy("k", "row", "paragraph", "anchored").agg(*sums, *hits)

    z = F.array(*[(F.col(f"z{i}") + float(model.bias[i])) / model.temperature for i in range(n)])
    top = F.array_max("z")
    shares = [F.struct((F.col(f"t{i}") / size).alias("share"), F.lit(-i).alias("less"), F.lit(FAMILIES.index(f)).alias("of"))
              for i, (f, size) in enumerate(templates)]
    scored = scored.where(F.col("anchored") | (F.greatest(*[F.col(f"t{i}") / size for i, (_, size) in enumerate(templates)]) >= CONTAINMENT))
    scored = scored.select("k", "paragraph", z.alias("z"), F.array(*shares).alias("shares")).withColumns({
        "best": F.array_position("z", top).cast("int") - 1,
        "probability": 1 / F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - top))})
    scored = scored.withColumn("match", F.array_max(F.filter("shares", lambda s: s["of"] == F.col("best"))))
    containment = F.coalesce(F.col("match.share"), F.lit(0.0))
    confirmed = (F.col("best") > 0) & (F.col("probability") >= PROBABILITY) & (containment >= CONTAINMENT)
    names = F.array(*map(F.lit, FAMILIES))
    return scored.select(
        F.col("k").alias(key), "paragraph", F.when(confirmed, F.get(names, F.col("best"))).otherwise(UNKNOWN).alias("family"),
        "probability", F.coalesce(-F.col("match.less"), F.lit(-1)).alias("template"), containment.alias("containment"), confirmed.alias("confirmed"))
