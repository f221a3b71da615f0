"""Licence scans: a trained paragraph classifier with template confirmation.

A paragraph is a line; its terms are its distinct words and word pairs. The
classes are the licence families below and "none". The training rows are the
templates and their variants with words left out, against paragraphs of at
most ``max_negative_docs`` documents (taken in the order of a hash of their
id). A multinomial logistic regression with an L1 penalty is fitted over the
terms of the templates, so its weights are sparse and any paragraph without
such terms scores as "none". On rows kept out of the fit the probability a
family must reach is chosen (``calibrate``).

Scanning: every line of every document is exploded to its terms and joined
with the table of weighted terms (at most the terms of the templates, so it
is broadcast); what is left is summed per line by an aggregate that combines
before the shuffle. A family is confirmed when the probability of all families
together reaches the calibrated bound and the paragraph holds at least
``min_containment`` of the word pairs of one of the family's templates. Of
several families the likeliest (if it reaches the bound alone), then the best
contained comes first; a further one must hold as large a share of the pairs
that the families before it do not have. A paragraph likelier to be some
licence than none but not so confirmed is "unknown". DataFrame functions only;
the fit is pyspark.ml's.

Wrapped statements: where the lines of a document that do not have a family
by themselves hold, with the pairs across their ends, ``min_containment`` of
one of its templates together, each line end of the document
between two lines with words is scored as well, with as many words on either
side as the longest template has (up to a line without words). Statements that
run over lines are thus met at one line end at least. Neighbouring line ends
with the same family are one finding, at the line the best of them starts in;
it is left out where a line of the group has that family by itself, and lines
of it are not "unknown". Unknown statements are found by line only.

Null and empty texts have one empty paragraph and no finding. Rows that
repeat a doc_id are told apart by a hash of their text; equal rows get equal
results. A null doc_id is scanned like any other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved

MAX_NEGATIVE_DOCS = 200
MIN_CONTAINMENT = 0.5
WHOLE = 20  # weight of an uncut template among its variants

# Opening statements of well-known licences, by family.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
        "SPDX-License-Identifier: MIT",
    ],
    "proprietary": [
        "All rights reserved.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ],
}
FAMILIES = sorted(TEMPLATES)
NONE = "none"
UNKNOWN = "unknown"
CLASSES = [*FAMILIES, NONE]

_WORD = "[\\p{L}\\p{N}]+(?:[.-][\\p{L}\\p{N}]+)*"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def _with_pairs(w: Column) -> Column:
    """Distinct words and neighbouring word pairs of a list of words."""
    return F.array_distinct(F.concat(w, F.zip_with(
        F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b))))


def terms(text: Column) -> Column:
    """Distinct words and neighbouring word pairs of a paragraph."""
    return F.transform(F.array(words_of(text)), _with_pairs)[0]


def paragraphs(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


@dataclass
class Model:
    """``weights``: term, one weight per class, and the templates it is a
    word pair of; small (the terms of the templates)."""
    weights: DataFrame
    intercepts: list[float]
    bound: float
    pairs: list[tuple[str, int]]  # family and number of word pairs by template


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(k, f, t) for k, (f, t) in enumerate((f, t) for f in FAMILIES for t in TEMPLATES[f])]
    return spark.createDataFrame(rows, "template int, family string, text string")


def training_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  max_negative_docs: int = MAX_NEGATIVE_DOCS) -> DataFrame:
    """(text, label, weight, held): templates whole (``WHOLE`` times) and with up to two words left
    out, and paragraphs of a bounded sample of documents. A sampled paragraph
    that states a template verbatim is no negative."""
    spark = docs.sparkSession
    made = _templates(spark)
    words = F.split("text", " ")
    gaps = F.sequence(F.lit(0), F.size(words))  # past the end: no word is left out
    cut = made.withColumn("i", F.explode(gaps)).withColumn("j", F.explode(gaps)).where("i <= j")
    variants = cut.select(F.array_join(F.filter(words, lambda _, k: (k != F.col("i")) & (k != F.col("j"))), " ").alias("text"),
                          F.array_position(F.array(*[F.lit(c) for c in CLASSES]), F.col("family")).alias("c"),
                          F.size(words).alias("n"),
                          F.when(F.col("i") == F.size(words), float(WHOLE)).otherwise(1.0).alias("weight")
                          ).where("n > 3 or weight > 1").groupBy("text", "c").agg(F.max("weight").alias("weight"))
    stated = F.lit(False)
    for family in FAMILIES:
        for t in TEMPLATES[family]:
            stated = stated | F.contains("text", F.lit(t.lower().rstrip(".")))
    sample = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).orderBy(
        F.xxhash64("i"), "i", F.xxhash64("t")).limit(max_negative_docs)
    negative = (sample.select(F.explode(paragraphs(F.col("t"))).alias("line"))
                      .withColumn("text", F.lower("line")).where(~stated)
                      .select(F.col("line").alias("text")).distinct())
    rows = variants.select("text", (F.col("c") - 1).cast("double").alias("label"), "weight").unionByName(
        negative.select("text", F.lit(float(len(FAMILIES))).alias("label"), F.lit(1.0).alias("weight")))
    return rows.withColumn("held", (F.col("weight") == 1) & (F.pmod(F.xxhash64("text"), F.lit(5)) == 0))


def calibrate(found: list[tuple[float, bool]], precision: float = 0.99) -> float:
    """Smallest probability bound from 0.5 up at which at least ``precision``
    of the predictions on held rows are right; 0.9 where none is."""
    for step in range(50, 100):
        right = [ok for p, ok in found if p >= step / 100]
        if right and sum(right) >= precision * len(right):
            return step / 100
    return 0.9


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          max_negative_docs: int = MAX_NEGATIVE_DOCS) -> Model:
    """Fit on the templates and a bounded sample of the documents."""
    spark = docs.sparkSession
    made = _templates(spark).withColumn("terms", terms(F.col("text")))
    rows = saved(training_rows(docs, id_col=id_col, text_col=text_col, max_negative_docs=max_negative_docs)
                 .withColumn("terms", terms(F.col("text"))).repartition(2))
    vocabulary = sorted({t for r in made.collect() for t in r["terms"]})
    counter = CountVectorizerModel.from_vocabulary(vocabulary, "terms", "features")
    counter.setBinary(True)
    seen = counter.transform(rows)
    fitted = LogisticRegression(family="multinomial", elasticNetParam=1.0, regParam=1e-4, maxIter=60, weightCol="weight",
                                standardization=False).fit(seen.where("not held"))
    held = fitted.transform(seen.where("held")).select("label", "prediction", "probability").collect()
    none = float(len(FAMILIES))
    bound = calibrate([(max(r["probability"]), r["label"] == r["prediction"]) for r in held if r["prediction"] != none])
    matrix = fitted.coefficientMatrix.toArray()
    known = matrix.shape[0]  # classes up to the largest label seen
    intercept = [float(x) for x in fitted.interceptVector.toArray()]
    intercept += [-40.0] * (len(CLASSES) - known)
    pairs_of = {}
    templates = []
    for r in sorted(made.collect(), key=lambda r: r["template"]):
        pairs = [t for t in r["terms"] if " " in t]
        templates.append((r["family"], len(pairs)))
        for t in pairs:
            pairs_of.setdefault(t, []).append(r["template"])
    table = []
    for k, t in enumerate(vocabulary):
        w = [float(matrix[c, k]) if c < known else 0.0 for c in range(len(CLASSES))]
        if t in pairs_of or any(abs(x) > 1e-9 for x in w):
            table.append((t, w, pairs_of.get(t, [])))
    weights = spark.createDataFrame(table, "term string, w array<double>, templates array<int>")
    return Model(weights, intercept, bound, templates)


_BITS = 63  # pairs of the templates by bit of a long


class _Pairs:
    """Word pairs of the templates as bits of a few longs."""

    def __init__(self, model: Model):
        rows = sorted((r["term"], r["templates"]) for r in model.weights.select("term", "templates").collect()
                      if r["templates"])
        self.longs = max(1, -(-len(rows) // _BITS))
        self.bit = {t: divmod(k, _BITS) for k, (t, _) in enumerate(rows)}
        self.family = [f for f, _ in model.pairs]
        self.size = [max(n, 1) for _, n in model.pairs]
        self.mask = [[0] * self.longs for _ in model.pairs]
        for t, templates in rows:
            j, k = self.bit[t]
            for m in templates:
                self.mask[m][j] |= 1 << k

    def weights(self, model: Model) -> DataFrame:
        spark = model.weights.sparkSession
        none = [0] * self.longs
        rows = []
        for r in model.weights.collect():
            m = list(none)
            if r["term"] in self.bit:
                j, k = self.bit[r["term"]]
                m[j] = 1 << k
            rows.append((r["term"], r["w"], m))
        return spark.createDataFrame(rows, "term string, w array<double>, m array<bigint>")

    def held(self, template: int, prefix: str) -> Column:
        """Number of the template's pairs among those of columns prefix0, ..."""
        got = F.lit(0)
        for j, m in enumerate(self.mask[template]):
            if m:
                got = got + F.bit_count(F.col(f"`{prefix}{j}`").bitwiseAND(F.lit(m).cast("long")))
        return got

    def share(self, prefix: str) -> Column:
        return F.array(*[self.held(t, prefix) / n for t, n in enumerate(self.size)])


def _lines(docs: DataFrame, id_col: str, text_col: str, make) -> DataFrame:
    """doc_id, row_key, and ``make`` of the words by line (one line at
    least, so callers explode it as outer: no filter evaluates it twice)."""
    by_line = F.transform(paragraphs(F.col(text_col)), words_of)
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("row_key"),
                       F.transform(F.array(by_line), make)[0].alias("made"))


def _scored(units: DataFrame, model: Model, pairs: _Pairs, weights: DataFrame) -> DataFrame:
    """Sums per unit. ``units``: doc_id, row_key, paragraph, words and across
    (the pair over the end of the line, or null). The pairs of a unit are the
    bits of o0, ..., with the one across those of x0, ..."""
    # never empty; of an inner explode Spark makes a filter that works out the list again
    hits = units.select("doc_id", "row_key", "paragraph", F.explode_outer(F.concat(
        F.transform(_with_pairs(F.col("words")), lambda t: F.struct(t.alias("term"), F.lit(False).alias("over"))),
        F.array(F.struct(F.col("across").alias("term"), F.lit(True).alias("over"))))).alias("t"))
    hits = hits.select("doc_id", "row_key", "paragraph", "t.term", "t.over").join(F.broadcast(weights), "term")
    inside = ~F.col("over")
    made = [F.sum(F.when(inside, F.col("w")[c])).alias(f"z{c}") for c in range(len(CLASSES))]
    for j in range(pairs.longs):
        made += [F.bit_or(F.when(inside, F.col("m")[j]).otherwise(F.lit(0).cast("long"))).alias(f"o{j}"),
                 F.bit_or(F.col("m")[j]).alias(f"x{j}")]
    z = F.array(*[F.col(f"z{c}") + F.lit(model.intercepts[c]) for c in range(len(CLASSES))])
    bits = [f"{k}{j}" for k in "ox" for j in range(pairs.longs)]
    return (hits.groupBy("doc_id", "row_key", "paragraph").agg(*made)
                .select("doc_id", "row_key", "paragraph", z.alias("z"), *bits)
                .withColumn("e", F.transform("z", lambda x: F.exp(x - F.array_max("z"))))
                .withColumn("p", F.transform("e", lambda x: x / F.aggregate("e", F.lit(0.0), lambda a, y: a + y)))
                .drop("z", "e"))


def _judged(scored: DataFrame, model: Model, pairs: _Pairs, min_containment: float) -> DataFrame:
    """Adds the confirmed families (found) and what they are taken from."""
    longs = range(pairs.longs)
    union = {f: [0] * pairs.longs for f in FAMILIES}
    for t, f in enumerate(pairs.family):
        union[f] = [a | b for a, b in zip(union[f], pairs.mask[t])]
    # equal probabilities: the family first in order wins
    scored = (scored.withColumn("share", pairs.share("o"))
                    .withColumn("top", F.array_max(F.slice("p", 1, len(FAMILIES))))
                    .withColumn("best", F.array_position(F.slice("p", 1, len(FAMILIES)), F.col("top")).cast("int"))
                    .withColumn("none", F.element_at("p", len(CLASSES))))
    long = lambda x: F.lit(x).cast("long")
    candidates = F.array_sort(F.array(*[F.struct(
        F.when((F.col("top") >= model.bound) & (F.col("best") == FAMILIES.index(f) + 1), 0).otherwise(1).alias("rank"),
        (-F.col("share")[t]).alias("less"), F.lit(t).alias("t"), F.lit(f).alias("f"),
        *[long(pairs.mask[t][j]).alias(f"m{j}") for j in longs],
        *[long(union[f][j]).alias(f"u{j}") for j in longs]) for t, f in enumerate(pairs.family)]))
    start = F.struct(F.array().cast("array<string>").alias("f"), *[long(0).alias(f"u{j}") for j in longs])

    def take(acc, c):
        """The family too, if its own pairs are held as well."""
        own, held = F.lit(0), F.lit(0)
        for j in longs:
            left = c[f"m{j}"].bitwiseAND(F.bitwise_not(acc[f"u{j}"]))
            own = own + F.bit_count(left)
            held = held + F.bit_count(left.bitwiseAND(F.col(f"o{j}")))
        fits = ((-c["less"] >= min_containment) & (own > 0) & (held >= own * min_containment)
                & ~F.array_contains(acc["f"], c["f"]))
        return F.when(fits, F.struct(
            F.concat(acc["f"], F.array(c["f"])).alias("f"),
            *[acc[f"u{j}"].bitwiseOR(c[f"u{j}"]).alias(f"u{j}") for j in longs])).otherwise(acc)

    sure = (1 - F.col("none") >= model.bound) & (F.array_max("share") >= min_containment)
    found = F.when(sure, F.aggregate(candidates, start, take, lambda acc: acc["f"])).otherwise(
        F.array().cast("array<string>"))
    return scored.withColumn("found", found)


def _findings(judged: DataFrame, pairs: _Pairs) -> DataFrame:
    """One row per unit and confirmed family, or one as ``UNKNOWN``."""
    names = F.array(*[F.lit(f) for f in FAMILIES])
    of_family = F.array(*[F.array(*[F.lit(t + 1) for t, f in enumerate(pairs.family) if f == family])
                          for family in FAMILIES])
    judged = (judged.where((F.size("found") > 0) | (F.col("none") < 0.5))
                    .withColumn("family", F.explode(F.when(F.size("found") > 0, F.col("found")).otherwise(
                        F.array(F.lit(UNKNOWN)))))
                    .withColumn("at", F.when(F.col("family") == UNKNOWN, F.col("best")).otherwise(
                        F.array_position(names, F.col("family")).cast("int"))))
    return judged.select("doc_id", "row_key", "paragraph", "family",
                         F.round(F.element_at("p", F.col("at")), 6).alias("probability"),
                         F.array_max(F.transform(F.element_at(of_family, F.col("at")),
                                                 lambda t: F.element_at("share", t))).alias("containment"))


def _wrapped(docs: DataFrame, held: DataFrame, model: Model, pairs: _Pairs, weights: DataFrame, id_col: str,
             text_col: str, min_containment: float) -> DataFrame:
    """Findings of statements over several lines, with the last line."""
    open_ = {f: ~F.array_contains(F.coalesce("found", F.array().cast("array<string>")), f) for f in FAMILIES}
    masks = [F.bit_or(F.when(open_[f], F.col(f"x{j}")).otherwise(F.lit(0).cast("long"))).alias(f"{f}/{j}")
             for f in FAMILIES for j in range(pairs.longs)]
    share = F.array(*[pairs.held(t, f"{f}/") / n for t, (f, n) in enumerate(zip(pairs.family, pairs.size))])
    several = saved(held.groupBy("doc_id", "row_key").agg(*masks).where(F.array_max(share) >= min_containment)
                        .select(F.col("doc_id").alias("_i"), F.col("row_key").alias("_k")))
    mine = docs.select(id_col, text_col).join(several, F.col(id_col).eqNullSafe(F.col("_i"))
                                              & (F.xxhash64(text_col) == F.col("_k")), "left_semi")
    reach = max(len(t.split()) for f in FAMILIES for t in TEMPLATES[f])
    start = F.struct(F.array().cast("array<string>").alias("w"), F.lit(True).alias("on"), F.lit(0).alias("n"))

    def after(lines, k):
        """The words after line k up to ``reach`` and a line without any."""
        def more(acc, w):
            on = acc["on"] & (F.size(w) > 0) & (F.size(acc["w"]) < reach)
            return F.struct(F.when(on, F.concat(acc["w"], F.slice(w, 1, reach))).otherwise(acc["w"]).alias("w"),
                            on.alias("on"), (acc["n"] + on.cast("int")).alias("n"))
        return F.aggregate(F.slice(lines, k + 2, reach), start, more)

    def groups(lines):
        return F.transform(lines, lambda w, k: F.struct(F.slice(
            w, F.greatest(F.size(w) - reach + 1, F.lit(1)), reach).alias("w"), after(lines, k).alias("next")))

    lines = _lines(mine, id_col, text_col, groups).select("doc_id", "row_key", F.posexplode_outer("made").alias("paragraph", "g"))
    units = saved(lines.where((F.size("g.w") > 0) & (F.col("g.next.n") > 0)).select(
        "doc_id", "row_key", "paragraph", F.concat("g.w", F.slice("g.next.w", 1, reach)).alias("words"),
        (F.col("paragraph") + F.col("g.next.n")).alias("last")).dropDuplicates(["doc_id", "row_key", "paragraph"]))
    scored = _scored(units.withColumn("across", F.lit(None).cast("string")), model, pairs, weights)
    found = _findings(_judged(scored, model, pairs, min_containment), pairs).where(F.col("family") != UNKNOWN)
    ends = units.select(F.col("doc_id").alias("_i"), F.col("row_key").alias("_k"), F.col("paragraph").alias("_p"), "last")
    return found.join(ends, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("row_key") == F.col("_k"))
                      & (F.col("paragraph") == F.col("_p"))).drop("_i", "_k", "_p")


def scan(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text",
         min_containment: float = MIN_CONTAINMENT) -> DataFrame:
    """Findings: doc_id, row_key (hash of the text), paragraph (position),
    family, probability and containment of its best matching template. A
    paragraph that states several families has a row for each."""
    pairs = _Pairs(model)
    weights = saved(pairs.weights(model))
    follows = lambda lines: F.transform(lines, lambda w, k: F.struct(
        w.alias("words"), F.when((F.size(w) > 0) & (F.size(F.get(lines, k + 1)) > 0), F.concat_ws(
            " ", F.element_at(w, -1), F.get(lines, k + 1)[0])).alias("across")))
    lines = _lines(docs, id_col, text_col, follows).select(
        "doc_id", "row_key", F.posexplode_outer("made").alias("paragraph", "line")).select(
            "doc_id", "row_key", "paragraph", "line.words", "line.across")
    any_pair = F.lit(False)
    for j in range(pairs.longs):
        any_pair = any_pair | (F.col(f"x{j}") != 0)
    scored = _scored(lines, model, pairs, weights).where(any_pair | (F.element_at("p", len(CLASSES)) < 0.5))
    held = saved(_judged(scored, model, pairs, min_containment))
    # a line that has nothing but the pair across its end is not scored itself
    single = saved(_findings(held.where("p[0] is not null"), pairs))
    over = _wrapped(docs, held, model, pairs, weights, id_col, text_col, min_containment)
    same = lambda a, b: (F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))
                         & (F.col(f"{a}.row_key") == F.col(f"{b}.row_key")))
    within = F.col("s.paragraph").between(F.col("g.paragraph"), F.col("g.last"))
    over = over.alias("g").join(single.alias("s"), same("g", "s") & within & (F.col("s.family") == F.col("g.family")),
                                "left_anti")
    # neighbouring line ends with the same family are one finding
    w = Window.partitionBy("doc_id", "row_key", "family").orderBy("paragraph")
    over = over.withColumn("new", F.coalesce(F.col("paragraph") - F.lag("paragraph").over(w) > 1, F.lit(True)))
    over = over.withColumn("island", F.sum(F.col("new").cast("int")).over(w))
    top = F.max(F.struct("containment", "probability", (-F.col("paragraph")).alias("less"), "last")).alias("top")
    over = saved(over.groupBy("doc_id", "row_key", "family", "island").agg(top).select(
        "doc_id", "row_key", (-F.col("top.less")).alias("paragraph"), "family", "top.probability", "top.containment",
        "top.last"))
    rest = single.alias("s").join(over.alias("g"), same("s", "g") & within & (F.col("s.family") == UNKNOWN), "left_anti")
    return rest.unionByName(over.drop("last"))


def summary(docs: DataFrame, findings: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: paragraphs, licence paragraphs, unknown ones
    and the confirmed families."""
    known = F.col("family") != UNKNOWN
    by_line = findings.groupBy("doc_id", "row_key", "paragraph").agg(
        F.collect_set(F.when(known, F.col("family"))).alias("f"), F.max((~known).cast("int")).alias("u"))
    by_doc = saved(by_line.groupBy("doc_id", "row_key").agg(
        F.count(F.when(F.size("f") > 0, 1)).alias("n"), F.sum("u").alias("u"),
        F.array_distinct(F.flatten(F.collect_list("f"))).alias("f")))
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("row_key"),
                       F.size(paragraphs(F.col(text_col))).cast("long").alias("n_paragraphs"))
    b = by_doc.select(F.col("doc_id").alias("_i"), F.col("row_key").alias("_k"), "n", "u", "f")
    return base.join(b, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("row_key") == F.col("_k")), "left").select(
        "doc_id", "n_paragraphs", F.coalesce("n", F.lit(0)).alias("n_license"),
        F.coalesce("u", F.lit(0)).alias("n_unknown"),
        F.coalesce(F.array_join(F.array_sort("f"), ","), F.lit("")).alias("families"))
