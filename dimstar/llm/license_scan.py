"""Licence scan with a trained paragraph classifier, as DataFrame operations only.

Paragraphs are lines with a word, and blocks: two or more such lines in a row,
as a hard-wrapped notice has them, numbered by their first line. The words and
word pairs that they share with the templates make a sparse vector, and a
multinomial logistic regression with a lasso penalty gives each paragraph a
probability per licence family and for "no licence".

A block is reported if it is given a family that none of its lines has by
itself; of its lines, those at least ``PART`` as like that family as their own
are then parts of the notice and not reported. A block is reported as
``unknown`` only if none of its lines is reported.

Training needs no labels in the tables: positive rows are the templates and
variants of them (one word left out, beginnings, ends, template inside other
words); negative rows are paragraphs of the documents that share little with
any template, about ``BACKGROUND`` of the lines and the same share of the
blocks, chosen by their hash.
The samples of background paragraphs (``BACKGROUND``, ``EMBEDDED``) are the only
bounded step; every paragraph of every document is classified.

Calibration: a fold of the training rows is held out. The probability that a
family needs is the smallest at which no held-out negative row would get it,
but ``FLOOR`` at least; a licence-like paragraph below it is ``unknown``.
Confirmation: a family's paragraph must contain ``CONFIRM`` of the word pairs
of one of its templates; with fewer it is ``unknown`` as well, and with less
than ``DOUBT`` of them it is taken for no licence after all.

Defined cases: null and empty texts have no paragraphs; repeated rows give
repeated results; a table without any text trains on the templates alone; only
the id and text columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import hashed_share, materialise

# Sentences by which well-known licences are referred to.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
    ],
    "bsd-3-clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Dedicated to the public domain under CC0 1.0.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Released under the Mozilla Public License 2.0.",
    ],
    "all-rights-reserved": [
        "All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
    ],
}
FAMILIES = sorted(TEMPLATES)
NONE = len(FAMILIES)  # class number of "no licence"
BACKGROUND = 20_000
EMBEDDED = 400
LASSO = 2e-4
FLOOR = 0.5
CONFIRM = 0.6
DOUBT = 0.15
PART = 0.5
_NOISE = r"[^\p{L}\p{N}\x20\x09-\x0D]+"
_SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Lower-case words; other characters part words."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), _NOISE, " "), _SPACE), lambda w: w != "")


def pairs(w: Column) -> Column:
    """Neighbouring words, joined by a space."""
    return F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))),
                      F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, paragraph, lines, block, words): lines with a word and blocks
    of several, numbered from 0 by (first) line; ``block`` is the hash of the
    block that the paragraph is or lies in."""
    # words are made before the generators: what follows reads their output and does not make them again
    split = F.transform(F.split(F.col(f"`{text_col}`").cast("string"), "\n"), words)
    read = docs.select(F.col(f"`{id_col}`").alias("doc_id"), split.alias("split"))
    filled = lambda i: F.coalesce(F.size(F.get("split", i)), F.lit(0)) > 0
    at = F.sequence(F.lit(0), F.size("split") - 1)
    first, last = F.filter(at, lambda i: filled(i) & ~filled(i - 1)), F.filter(at, lambda i: filled(i) & ~filled(i + 1))
    blocks = F.zip_with(first, last, lambda a, b: F.struct(
        a.alias("start"), F.slice("split", a + 1, b - a + 1).alias("part")))
    block = read.select("doc_id", F.explode_outer(F.when(F.col("split").isNotNull(), blocks)).alias("b")).select(
        "doc_id", "b.start", "b.part", F.xxhash64("b.start", "b.part").alias("block"))
    lines = F.transform("part", lambda w, i: F.struct((F.col("start") + i).alias("paragraph"), F.lit(1).alias("lines"),
                                                      w.alias("words")))
    whole = F.transform(F.array(F.flatten("part")), lambda w: F.struct(
        F.col("start").alias("paragraph"), F.size("part").alias("lines"), w.alias("words")))
    both = F.when(F.size("part") > 1, F.concat(lines, whole)).otherwise(lines)
    found = block.select("doc_id", "block", F.explode_outer(both).alias("p"))
    return found.select("doc_id", "p.paragraph", "p.lines", "block", "p.words").filter(F.size("words") > 0)


def _templates(spark: SparkSession) -> DataFrame:
    """(family, words, grams); one row per template sentence."""
    rows = [(i, t) for i, f in enumerate(FAMILIES) for t in TEMPLATES[f]]
    named = spark.createDataFrame(rows, "family int, text string").select("family", words(F.col("text")).alias("words"))
    return named.withColumn("grams", F.array_distinct(pairs(F.col("words"))))


def _likeness(spark: SparkSession, grams: Column, family: int | None = None) -> Column:
    """Greatest share of a template's word pairs that ``grams`` has. The
    templates are constants of this module, so they are literals of the plan."""
    known = [r.grams for r in _templates(spark).collect() if family is None or r.family == family]
    return reduce(F.greatest, [F.size(F.array_intersect(grams, F.array(*map(F.lit, g)))) / F.lit(float(len(g)))
                               for g in known] + [F.lit(0.0)])


def _features(rows: DataFrame) -> DataFrame:
    """Counts (0 or 1) of the templates' words and pairs, as a sparse vector ``x``."""
    known = sorted({t for r in _templates(rows.sparkSession).collect() for t in [*r.words, *r.grams]})
    counter = CountVectorizerModel.from_vocabulary(known, inputCol="terms", outputCol="x").setBinary(True)
    return counter.transform(rows.withColumn("terms", F.concat("words", pairs(F.col("words")))))


def training_rows(spark: SparkSession, found: DataFrame, total: int, background: int = BACKGROUND,
                  embedded: int = EMBEDDED) -> DataFrame:
    """(family, words, held): templates with variants, about ``background`` of
    ``total`` paragraphs as background, and templates between the words of
    about ``embedded`` of these. Both samples are shares of hashes."""
    sample = found.select("words").filter(
        hashed_share([F.array_join("words", " ")], background, total)).distinct()
    sample = materialise(sample.select("words", F.array_distinct(pairs(F.col("words"))).alias("grams")),
                         "licence-sample")
    negative = materialise(sample.filter(_likeness(spark, F.col("grams")) < 0.3).select(
        F.lit(NONE).alias("family"), "words").distinct(), "licence-background")
    t = _templates(spark).select("family", "words")
    n = F.size("words")
    left_out = t.filter(n > 5).select("family", "words", F.explode(F.sequence(F.lit(1), n)).alias("i")).select(
        "family", F.concat(F.slice("words", F.lit(1), F.col("i") - 1), F.slice("words", F.col("i") + 1, n)).alias("words"))
    parts = t.filter(n > 5).select("family", F.explode(F.array(
        F.slice("words", F.lit(1), F.ceil(n * 0.8).cast("int")),
        F.slice("words", (n * 0.2).cast("int") + 1, n))).alias("words"))
    # a template between other words, so that its own words decide
    longer = negative.filter(F.size("words") > 20)
    share = hashed_share([F.lit("embedded"), F.array_join("words", " ")], embedded, longer.count())
    around = longer.filter(share).select(
        F.slice("words", 1, 8).alias("before"), F.slice("words", 9, 8).alias("after"),
        (F.pmod(F.xxhash64("words"), F.lit(len(FAMILIES)))).cast("int").alias("family"))
    inside = around.join(F.broadcast(t), "family").select("family", F.concat("before", "words", "after").alias("words"))
    copies = t.select("family", "words", F.explode(F.sequence(F.lit(1), F.lit(20))).alias("i")).select("family", "words")
    rows = copies.unionByName(left_out).unionByName(parts).unionByName(inside).unionByName(negative)
    return materialise(rows.withColumn("held", F.pmod(F.xxhash64("words"), F.lit(5)) == 0), "licence-training")


def fit(rows: DataFrame, lasso: float = LASSO) -> tuple[LogisticRegressionModel, float]:
    """The model and the probability that a family needs."""
    x = _features(rows).select("x", F.col("family").cast("double").alias("label"), "held",
                               F.when(F.col("family") == NONE, 1.0).otherwise(4.0).alias("weight"))
    # templates are few and must all be learnt; only negative rows are held out
    model = LogisticRegression(featuresCol="x", labelCol="label", weightCol="weight", family="multinomial",
                               regParam=lasso, elasticNetParam=1.0, standardization=False, maxIter=80).fit(
        x.filter(~F.col("held") | (F.col("label") < NONE)))
    p = vector_to_array("probability")
    top = model.transform(x.filter((F.col("label") == NONE) & F.col("held"))).agg(
        F.max(F.array_max(F.slice(p, 1, NONE))).alias("top")).first().top
    return model, max(FLOOR, min(0.95, top or 0.0))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", background: int = BACKGROUND) -> DataFrame:
    """(doc_id, paragraph, licence, probability, likeness) of the paragraphs
    that refer to a licence; ``licence`` is a family or ``unknown``."""
    spark = docs.sparkSession
    found = paragraphs(docs, id_col, text_col)
    lines = F.size(F.split(F.col(f"`{text_col}`").cast("string"), "\n"))
    total = docs.agg(F.coalesce(F.sum(F.greatest(lines, F.lit(0))), F.lit(0)).alias("n")).first().n
    model, need = fit(training_rows(spark, found, total, background))
    # the condition is tested inside a generator, so that the model runs once per paragraph
    row = F.struct("doc_id", "paragraph", "lines", "block", "words", vector_to_array("probability").alias("p"))
    likely = model.transform(_features(found)).select(
        F.explode_outer(F.filter(F.array(row), lambda r: F.element_at(r["p"], NONE + 1) < 0.5)).alias("r"))
    scored = materialise(likely.filter("r IS NOT NULL").select("r.*").withColumn(
        "grams", F.array_distinct(pairs(F.col("words")))), "licence-likely")
    # only the few paragraphs left are compared with the templates
    best = F.array_max(F.slice("p", 1, NONE))
    named = scored.withColumn("best", best).withColumn("family", F.array_position(F.slice("p", 1, NONE), F.col("best")) - 1)
    likes = F.array(*[_likeness(spark, F.col("grams"), i) for i in range(len(FAMILIES))])
    of = lambda i: F.element_at("likes", (i + 1).cast("int"))
    sure = (F.col("best") >= need) & (F.col("likeness") >= CONFIRM)
    judged = materialise(
        named.withColumn("likes", likes).withColumn("likeness", of(F.col("family"))).filter(F.col("likeness") >= DOUBT)
        .select("doc_id", "paragraph", "lines", "block", "family", "best", "likeness", "likes", sure.alias("sure")),
        "licence-judged")
    # what the lines of a block say, and the family that only the whole block has
    line, together = F.col("lines") == 1, Window.partitionBy("doc_id", "block")
    told = judged.withColumn("by_line", F.collect_set(F.when(line & F.col("sure"), F.col("family"))).over(together)) \
        .withColumn("any_line", F.max(line).over(together)) \
        .withColumn("by_block", F.max(F.when(~line & F.col("sure") & ~F.array_contains("by_line", F.col("family")),
                                             F.col("family"))).over(together))
    part = F.coalesce(of(F.col("by_block")) >= PART * F.col("likeness"), F.lit(False))
    reported = F.when(line, ~part).when(F.col("sure"), F.col("by_block").isNotNull()).otherwise(~F.col("any_line"))
    names = F.array(*map(F.lit, FAMILIES))
    return told.filter(reported).select(
        "doc_id", "paragraph",
        F.when(F.col("sure"), F.element_at(names, (F.col("family") + 1).cast("int"))).otherwise("unknown").alias("licence"),
        F.round("best", 4).alias("probability"), F.round("likeness", 4).alias("likeness"))
