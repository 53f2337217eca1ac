"""License scan: a trained classifier of paragraphs over sparse word n-grams, confirmed by template comparison.

The model is a multinomial logistic regression over word 1- to 3-grams of licence statements, with a class for
anything else. It is fitted here, on wordings of the statements below and on paragraphs that are none, and its
confidence is calibrated by one temperature on wordings kept back. A paragraph belongs to a family if the calibrated
probability is at least one half and its n-grams cover enough of one of the family's templates.

Every n-gram of the model has a word of its own that isn't a common one, so paragraphs without any such word have the
constant score of the unknown class and need no look-up; for the others n-grams are joined with the table of weights,
whose size is bounded by the templates. Scoring is DataFrame functions alone.

Defined cases: NULL and empty texts have no licence; repeated rows are scanned each and reported by id; rows that
share an id are one document; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import text_or_empty
from .quality import descend

UNKNOWN = "unknown"
THRESHOLD = 0.5
COVER = 0.6  # of a template's n-grams
GRAMS = 3
BETWEEN = r"[\s.,;:!?()\[\]\"'*#|<>/]+"  # what stands between words

# Statements by which texts name their licence.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "You may not use this file except in compliance with the Apache License Version 2.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "You can redistribute it and modify it under the terms of the GNU General Public License version 3 as published "
                "by the Free Software Foundation"),
    ("gpl-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("bsd", "Released under the BSD License."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc0", "Released under CC0 1.0 Universal, dedicated to the public domain."),
)
OTHERS = (
    "All rights reserved.",
    "Please see the license for details.",
    "The city issued a new license to the driver.",
    "He lost his license after the accident.",
    "The software was released in version 3 and again in version 2.0.",
    "A general meeting of the public took place.",
    "The Apache people live in the south west.",
    "Students of MIT released a report under pressure.",
    "The foundation published its work.",
    "Creative people use common tools.",
    "Permission was granted to use the hall free of charge.",
    "Source code in binary form.",
    "The attribution of the painting is uncertain.",
    "This document is licensed to the reader.",
    "Copyright by the authors.",
    "The universal rule of the public domain.",
)
COMMON = frozenset(
    "a an and any are as at be by can for from he his in is it its may not of on or that the this to under was were will with you".split()
)


def words_of(text: str) -> list[str]:
    return [w for w in re.split(BETWEEN, text.lower()) if w]


def grams_of(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + n]) for n in range(1, GRAMS + 1) for i in range(len(words) - n + 1)} - COMMON


@dataclass(frozen=True)
class LicenseModel:
    families: list[str]  # the last is the unknown class
    grams: list[str]
    weights: np.ndarray  # grams x families
    bias: np.ndarray
    temperature: float


def _wordings(text: str) -> list[str]:
    """A statement as texts have it: alone, within a sentence, with a copyright line, cut at its end."""
    words = text.split()
    cut = " ".join(words[: max(4, len(words) - 2)])
    return [text, f"This text is {text[0].lower()}{text[1:]}", f"Copyright 2020 by the authors. {text}", cut, f"Unless stated otherwise: {text} Thanks."]


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def train(templates=TEMPLATES, others=OTHERS, background: list[str] = ()) -> LicenseModel:
    """Fit from templates, other statements and background paragraphs; a matter of some hundred short texts."""
    families = [*dict.fromkeys(f for f, _ in templates), UNKNOWN]
    usable = lambda gram: any(w not in COMMON for w in gram.split())
    grams = sorted({g for _, text in templates for g in grams_of(words_of(text)) if usable(g)})
    column = {g: i for i, g in enumerate(grams)}
    rows = [(w, families.index(f), i) for f, text in templates for i, w in enumerate(_wordings(text))]
    rows += [(text, len(families) - 1, i) for i, text in enumerate([*others, *background])]
    x = np.zeros((len(rows), len(grams) + 1))
    x[:, -1] = 1
    for i, (text, _, _) in enumerate(rows):
        for g in grams_of(words_of(text)):
            if g in column:
                x[i, column[g]] = 1
    y = np.eye(len(families))[[f for _, f, _ in rows]]
    held = np.array([turn % 5 == 4 for _, _, turn in rows])
    balance = 1 / y[~held].sum(0).clip(1)
    weight = (y[~held] @ balance)[:, None]

    def gradient(flat: np.ndarray) -> np.ndarray:
        theta = flat.reshape(x.shape[1], -1)
        error = weight * (_softmax(x[~held] @ theta) - y[~held])
        return (x[~held].T @ error / len(families) + 1e-4 * theta).ravel()

    theta = descend(gradient, x.shape[1] * len(families), 300).reshape(x.shape[1], -1)
    margins = x[held] @ theta
    losses = {t: -np.log((_softmax(margins / t) * y[held]).sum(1).clip(1e-12)).mean() for t in np.linspace(0.25, 3, 45)}
    return LicenseModel(families, grams, theta[:-1], theta[-1], float(min(losses, key=losses.get)))


def words(text: Column) -> Column:
    """The same words as :func:`words_of`, by Spark."""
    return F.filter(F.split(F.lower(text), BETWEEN), lambda w: w != "")


def _grams(found: Column) -> Column:
    """Distinct n-grams of a list of words."""
    def of(n: int) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.size(found) - (n - 1), F.lit(1)))
        return F.transform(at, lambda i: F.array_join(F.slice(found, i, n), " "))

    parts = [found, *[of(n) for n in range(2, GRAMS + 1)]]
    return F.array_distinct(F.concat(*parts))


def license_paragraphs(documents: DataFrame, model: LicenseModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, paragraph, text, family, probability, cover, confirmed`` of paragraphs that aren't of the unknown class. Runs jobs.

    ``paragraph`` is the place of the line in its text.
    """
    spark = documents.sparkSession
    cues = sorted({w for g in model.grams for w in g.split() if w not in COMMON})
    lines = F.split(text_or_empty(F.col(f"`{text}`")), "\n")
    # Paragraphs without any cue have the constant score of no n-gram.
    own = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.posexplode(lines).alias("paragraph", "text"))
    own = own.withColumn("words", words(F.col("text"))).where(F.arrays_overlap("words", F.array(*map(F.lit, cues))))
    own = stage(own.select("doc_id", "paragraph", "text", F.monotonically_increasing_id().alias("row"), _grams(F.col("words")).alias("grams")), "paragraphs")

    schema = "gram string, " + ", ".join(f"w{i} double" for i in range(len(model.families)))
    table = [(g, *map(float, w)) for g, w in zip(model.grams, model.weights, strict=True)]
    weights = F.broadcast(spark.createDataFrame(table, schema))  # as many rows as the templates have n-grams
    found = own.select("row", F.explode("grams").alias("gram")).join(weights, "gram")
    sums = found.groupBy("row").agg(*[F.sum(f"w{i}").alias(f"w{i}") for i in range(len(model.families))])
    margins = [(F.col(f"w{i}") + F.lit(float(b))) / F.lit(model.temperature) for i, b in enumerate(model.bias)]
    powers = F.array(*[F.exp(m - F.greatest(*margins)) for m in margins])
    total = F.aggregate("powers", F.lit(0.0), lambda a, b: a + b)
    scored = sums.withColumn("powers", powers).withColumn("place", F.array_position("powers", F.array_max("powers")).cast("int"))
    scored = scored.select(
        "row",
        F.element_at(F.array(*map(F.lit, model.families)), F.col("place")).alias("family"),
        (F.array_max("powers") / total).alias("probability"),
    ).where((F.col("family") != UNKNOWN) & (F.col("probability") >= THRESHOLD))
    usable = set(model.grams)
    patterns = [(f, sorted(grams_of(words_of(t)) & usable)) for f, t in TEMPLATES]
    patterns = F.broadcast(spark.createDataFrame(patterns, "family string, pattern array<string>"))  # the templates
    scored = stage(scored, "scored").join(own, "row").join(patterns, "family")
    cover = F.size(F.array_intersect("grams", "pattern")) / F.size("pattern")
    best = scored.groupBy("row", "doc_id", "paragraph", "text", "family", "probability").agg(F.max(cover).alias("cover"))
    return best.select("doc_id", "paragraph", "text", "family", "probability", "cover", (F.col("cover") >= COVER).alias("confirmed"))


def scan(documents: DataFrame, model: LicenseModel | None = None) -> DataFrame:
    """``doc_id, license, licenses, paragraphs, probability`` for each document; ``license`` is ``none`` without a confirmed one."""
    found = license_paragraphs(documents, model or train()).where("confirmed")
    rank = F.struct(F.col("probability"), F.col("cover"), F.col("family"))
    by_document = found.groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(rank).alias("best"), F.sort_array(F.collect_set("family")).alias("families"), F.count(F.lit(1)).alias("n")
    )
    by_document = stage(by_document, "licenses")
    joined = documents.select("doc_id").join(by_document, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return joined.select(
        "doc_id",
        F.coalesce("best.family", F.lit("none")).alias("license"),
        F.coalesce(F.array_join("families", ","), F.lit("")).alias("licenses"),
        F.coalesce("n", F.lit(0)).cast("long").alias("paragraphs"),
        F.coalesce("best.probability", F.lit(0.0)).alias("probability"),
    )
