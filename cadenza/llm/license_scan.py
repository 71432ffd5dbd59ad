"""License scans: a trained paragraph classifier with a calibrated unknown class.

Paragraphs are lines without indentation and comment marks, and hard-wrapped lines joined
(``paragraphs_of``).  All of them
are scored by a multinomial logistic regression on the word 1-, 2- and 3-grams that the fixed notices
and sentences have, over the license families and "none".  A gram is found by its 64-bit hash, so other
grams never stand for it.  The model is fitted with Spark's
own LogisticRegression (elastic net) on ``TEMPLATES``: full, shortened and with words left out, among
words of a bounded sample of the corpus; the lines of that sample and sentences that only
sound like licenses are "none".

The unknown class is calibrated on held-out notices of no known family: the least probability
with which a family is accepted is the one that only ``UNKNOWN_SHARE`` of them reach.  A
family is confirmed if, too, the paragraph holds ``OVERLAP`` of the 3-grams (2-grams for short
ones) of one of its templates.  Where joined lines as a whole aren't confirmed, each of them
that is confirmed counts.  A paragraph that the model finds to be a license but of which nothing
is confirmed is unknown.

A paragraph is left out early only if its greatest possible lead of a family over "none", the sum of
each gram's greatest lead, isn't positive: then "none" is the likeliest (``_may_be_license``).

Scoring is native.  What may be a license is found row by row with one literal table of grams;
those few paragraphs are stored, and their grams joined to a broadcast table of weights and templates,
which has a row for each gram of the fixed notices (about 500).  NULL and empty texts have no
paragraphs; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import lookup_join
from .base import few_texts, stored, text_of

SLOTS = 1 << 17        # places of the table of grams at most; as many as give each gram its own
SAMPLE = 300           # rows of the corpus whose lines are negatives
SAMPLE_CHARS = 1 << 15
NEGATIVES = 600        # of those lines at most
VARIANTS = 24          # of each template
UNKNOWN_SHARE = 0.05
OVERLAP = 0.6

# Usual short notices of each family.
TEMPLATES = {
    "AGPL": ["This program is licensed under the GNU Affero General Public License, version 3.",
             "published under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "AGPL-3.0", "AGPLv3"],
    "Apache": ["Licensed under the Apache License, Version 2.0.",
               "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
               "SPDX-License-Identifier: Apache-2.0", "Apache-2.0"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Released under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause", "BSD-2-Clause"],
    "CC-BY": ["This work is licensed under a Creative Commons Attribution 4.0 International License.",
              "Licensed under CC BY 4.0.", "CC-BY-4.0"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0"],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"],
    "CC0": ["CC0 1.0 Universal public domain dedication", "This work is dedicated to the public domain under CC0.", "CC0-1.0"],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.",
            "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
            "SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0", "GPL-2.0", "GPLv3", "GPLv2"],
    "LGPL": ["This library is licensed under the GNU Lesser General Public License, version 2.1.",
             "redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "LGPL-3.0", "LGPL-2.1", "LGPLv3"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "SPDX-License-Identifier: MIT"],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "MPL-2.0"],
    "Proprietary": ["All rights reserved.", "Copyright 2020 Example Corporation. All rights reserved.",
                    "Unauthorized copying of this file is strictly prohibited. Proprietary and confidential license terms apply."],
}
#: Lines of the corpus with one of these, in lower case, aren't taken as examples of "none".
CUES = ("licens", "licenc", "copyright", "rights reserved", "permission", "redistribut", "public domain", "cc0",
        "cc by", "creative commons", "gnu ", "spdx")
#: Sentences that only sound like licenses.
SOUNDALIKES = [
    "He lost his driving licence last summer and had to take the bus.", "The fishing license costs ten dollars a year.",
    "She asked for permission to leave the room early.", "The band sold the rights to their licensed merchandise.",
    "A copyright dispute between the two authors went to court.", "The museum got a license to serve drinks.",
    "Permission slips must be signed by a parent before the trip.", "The gnu is a large antelope of the plains.",
    "Wealth was redistributed after the reform.", "The park is in the public domain of the city council.",
    "Licensed plumbers are hard to find in this town.", "Creative commons rooms are on the second floor.",
    "The court granted permission to appeal the decision.", "Its license plate was covered with mud.",
    "Copyright lawyers met in the city on Monday.", "The pilot renewed her licence in March."]
#: Notices of no known family, for calibration only.
STRANGERS = [
    "Licensed under the Quux Community License, version 1.1.", "Released under the Foobar Sharing Licence.",
    "This work is licensed under the Harbour Data License, version 4.", "Distributed under the terms of the Zephyr Software License.",
    "Licensed under the Meadow Research License 2.0.", "Released under the Blue Lantern License.",
    "This dataset is licensed under the Village Data Agreement.", "Published under the Riverbank Model Licence v3.",
    "Permission to use this model is granted under the Cobalt Licence.", "Redistribution is allowed under the Saffron Terms of Use.",
    "This file is under the Orchid Noncommercial License.", "Licensed for classroom use under the Teachers Common Licence.",
    "Use of these maps is subject to the Atlas Open Licence.", "Released under the Tundra Public Licence 5.",
    "SPDX-License-Identifier: LicenseRef-Harbour", "Copyright the Meadow Society; see the Meadow License for terms.",
    "This song is licensed under the Choir Sharing Agreement.", "Licensed under the Pebble End User License Agreement.",
    "The corpus is licensed under the Glacier Text License.", "Released under the Amber Source-Available License."]


# --- paragraphs ----------------------------------------------------------------------------

#: Stands between joined lines; no word has it.
JOINT = "\x0b"
_MARKS = r"(?m)^[ \t]*(?:(?:/[/*]+|\*+/?|#+|;+|--+|%+|>+|<!--+)[ \t]*)*|(?<![ \t])[ \t]*(?:\*+/|--+>)?[ \t\r]*$|\r+$"
#: A line as wide as a wrapped one, followed by neither an empty line nor a new item; behind the
#: end of a sentence, what follows must go on in lower case or with a number.
_WRAP = (r"(?m)^([^\n]{40,160})\n(?=[^\n])(?:(?<![.!?]\n)(?<![.!?][\"')\]]\n)|(?=[\p{Ll}0-9]))"
         r"(?!(?i:[-\u2022] |\(?[0-9]{1,2}[.)] |\(?[a-z]\) |spdx-|copyright\b|\u00a9))")


def paragraphs_of(text: Column) -> Column:
    """The paragraphs of a text; the lines of one are separated by ``JOINT``."""
    bare = F.regexp_replace(text, _MARKS, "")
    return F.split(F.regexp_replace(bare, _WRAP, "$1" + JOINT), "\n")


def readings_of(paragraph: Column) -> Column:
    """The texts judged: the paragraph, and its lines if it has several."""
    lines = F.split(paragraph, JOINT)
    return F.when(F.size(lines) > 1, F.concat(F.array(paragraph), lines)).otherwise(F.array(paragraph))


# --- features ------------------------------------------------------------------------------

def words_of(line: Column) -> Column:
    """Lower-case words; hyphens separate, and so does the v of GPLv3."""
    low = F.regexp_replace(F.lower(line), "plv([0-9])", "pl v$1")
    return F.array_remove(F.split(low, r"[^\p{L}\p{N}.+]+|[.]+(?= |$)", -1), "")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hashes_of(words: Column) -> Column:
    """Hashes of the different 1-, 2- and 3-grams, made from the hashes of their words."""
    return _let(F.transform(words, lambda w: F.xxhash64(w)), lambda a: _let(
        _longer(a, a, 2), lambda b: F.concat(a, b, _longer(b, a, 3))))


def _longer(h: Column, ones: Column, n: int) -> Column:
    """Hashes of n-grams from those of their beginnings and of single words."""
    m = F.greatest(F.size(ones) - (n - 1), F.lit(0))
    return F.zip_with(F.slice(h, F.lit(1), m), F.slice(ones, F.lit(n), m), lambda x, y: F.xxhash64(x, y))


def _hash_grams(ones: Column, n: int) -> Column:
    return ones if n == 1 else _longer(_hash_grams(ones, n - 1), ones, n)


def features_of(words: Column, grams: tuple[int, ...]) -> Column:
    """The indices in ``grams`` of the hashes that the words' n-grams have, each once."""
    slots = next(m for m in range(4 * len(grams) + 1, SLOTS, 2) if len({g % m for g in grams}) == len(grams))
    places = [0] * slots
    for i, g in enumerate(grams):
        places[g % slots] = i + 1
    place = lambda g: F.get(_literal(places, "int"), F.pmod(g, F.lit(slots)).cast("int")) - 1
    own = F.filter(hashes_of(words), lambda g: F.get(_literal(grams, "bigint"), place(g)) == g)
    return F.array_distinct(F.transform(own, place))


# --- training ------------------------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    """Families ("none" is one), the hashes of known grams, a weight for each family and gram, intercepts,
    the least probability of an accepted family, and of each template its family's place and its grams."""
    families: tuple[str, ...]
    grams: tuple[int, ...]
    weights: tuple[tuple[float, ...], ...]
    intercepts: tuple[float, ...]
    accept: float
    templates: tuple[tuple[int, tuple[int, ...]], ...]


def _lines(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """Fixed rows (family, line)."""
    made = F.explode(F.array(*(F.struct(F.lit(f).alias("family"), F.lit(x).alias("line")) for f, x in rows)))
    return spark.range(1).select(made.alias("r")).select("r.*")


def training_lines(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(family, words, fixed): templates in variants, and negatives from a bounded sample of the corpus.
    ``fixed`` rows have no words of the corpus."""
    spark = docs.sparkSession
    # stored: as literals the texts would be part of every plan made of them, which the driver keeps
    texts = stored(few_texts(docs, sample, SAMPLE_CHARS), "license-sample")
    corpus = texts.select(F.explode(paragraphs_of(F.col("text"))).alias("line"))
    quiet = ~_has_cue(F.col("line"))
    corpus = corpus.where(quiet & (F.trim("line") != "")).select(F.lit("none").alias("family"), words_of(F.col("line")).alias("words"))
    sound = _lines(spark, [("none", x) for x in SOUNDALIKES]).select("family", words_of(F.col("line")).alias("words"))
    fixed = _lines(spark, [(f, x) for f, xs in TEMPLATES.items() for x in xs]).select("family", words_of(F.col("line")).alias("words"))
    varied = fixed.select("family", "words", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("k"))
    stays = lambda w, i: F.pmod(F.xxhash64(w, i, "k"), F.lit(8)) >= F.when((F.col("k") < 4) | (F.size("words") < 4), 0).otherwise(1)
    # some variants end early, as the first line of a wrapped notice does
    n = F.size("words")
    varied = varied.withColumn("words", F.when((F.col("k") % 6 == 5) & (n >= 8), F.slice("words", F.lit(1), n - F.floor(n / 4).cast("int"))).otherwise(F.col("words")))
    varied = varied.select("family", F.filter("words", stays).alias("words"), "k")
    # some variants stand behind other words of the corpus, as in running text
    tails = (corpus.where(F.size("words") >= 4).select(F.slice("words", 1, 8).alias("tail"))
             .limit(VARIANTS).select("tail", (F.row_number().over(_by_tail()) - 1).alias("k")))
    varied = (varied.join(tails, "k", "left")
              .select("family", F.when(F.col("k") % 3 == 2, F.concat(F.coalesce("tail", F.array().cast("array<string>")), "words"))
                      .otherwise(F.col("words")).alias("words"), (F.col("k") % 3 != 2).alias("fixed")))
    return (varied.unionByName(corpus.limit(NEGATIVES).withColumn("fixed", F.lit(False)))
            .unionByName(sound.withColumn("fixed", F.lit(True))))


def _by_tail():
    from pyspark.sql import Window
    return Window.orderBy("tail")          # VARIANTS rows


def _has_cue(text: Column) -> Column:
    low = F.lower(text)
    out = F.contains(low, F.lit(CUES[0]))
    for c in CUES[1:]:
        out = out | F.contains(low, F.lit(c))
    return out


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizerModel
    families = ("none", *sorted(TEMPLATES))
    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    lines = training_lines(docs, sample).coalesce(2).cache()
    known = lines.where(F.col("fixed")).select(F.explode(hashes_of(F.col("words"))).alias("g")).distinct()
    grams = tuple(sorted(r["g"] for r in known.collect()))                    # of fixed notices only
    sparse = CountVectorizerModel.from_vocabulary([str(k) for k in range(len(grams))], "grams", "features", binary=True)
    rows = sparse.transform(lines.select(
        label.cast("double").alias("label"), features_of(F.col("words"), grams).cast("array<string>").alias("grams")))
    rows = rows.select("label", "features").cache()
    fitted = LogisticRegression(family="multinomial", maxIter=25, regParam=0.002, elasticNetParam=0.5).fit(rows)
    lines.unpersist()
    rows.unpersist()
    # families without a row (a corpus without lines has no "none" but the soundalikes) keep their place
    weights = tuple(tuple(float(x) for x in row) for row in fitted.coefficientMatrix.toArray())
    # grams without a weight add nothing
    used = [i for i in range(len(grams)) if any(row[i] for row in weights)] or [0]
    grams, weights = tuple(grams[i] for i in used), tuple(tuple(row[i] for i in used) for row in weights)
    model = Model(families, grams, weights, tuple(float(x) for x in fitted.interceptVector), 0.0, _templates(docs.sparkSession, families))
    strange = _lines(docs.sparkSession, [("?", x) for x in STRANGERS]).select("line", words_of(F.col("line")).alias("_words"))
    accept = judged(strange, ["line"], model).agg(F.percentile("family_probability", F.lit(1 - UNKNOWN_SHARE)).alias("q")).first()["q"]
    return replace(model, accept=min(0.95, max(0.5, float(accept or 0.0))))


def _templates(spark: SparkSession, families: tuple[str, ...]) -> tuple:
    """The hashes of each template's 3-grams, or of shorter grams for a template of few words."""
    rows = _lines(spark, [(f, x) for f, xs in TEMPLATES.items() for x in xs])
    h = F.transform(words_of(F.col("line")), lambda w: F.xxhash64(w))
    rows = rows.select("family", "line", *(F.array_distinct(_hash_grams(h, n)).alias(f"g{n}") for n in (1, 2, 3)))
    size = lambda x: 3 if len(x.split()) >= 6 else 2 if len(x.split()) >= 3 else 1
    return tuple((families.index(r["family"]), tuple(r[f"g{size(r['line'])}"])) for r in rows.orderBy("family", "line").collect())


# --- scoring -------------------------------------------------------------------------------

def _literal(numbers, kind: str = "double") -> Column:
    """An array literal; written as one string, which the optimizer folds, for a small plan."""
    return F.split(F.lit(" ".join(f"{x:.6g}" if kind == "double" else str(x) for x in numbers)), " ").cast(f"array<{kind}>")


def gram_table(spark: SparkSession, model: Model) -> DataFrame:
    """(gram, weights, templates) of each gram of the model or of a template: the weights of all families and the
    numbers of the templates that have it."""
    at, weights = {g: k for k, g in enumerate(model.grams)}, list(zip(*model.weights))
    held: dict[int, list[int]] = {g: [] for g in model.grams}
    for t, (_, grams) in enumerate(model.templates):
        for g in grams:
            held.setdefault(g, []).append(t)
    zero = [0.0] * len(model.families)
    lines = [f"{g};{' '.join(f'{w:.6g}' for w in (weights[at[g]] if g in at else zero))};{' '.join(map(str, ts))}" for g, ts in sorted(held.items())]
    part = lambda k: F.get(F.split("line", ";"), F.lit(k))
    return spark.range(1).select(F.explode(F.split(F.lit("\n".join(lines)), "\n")).alias("line")).select(
        part(0).cast("bigint").alias("gram"), F.split(part(1), " ").cast("array<double>").alias("weights"),
        F.transform(F.filter(F.split(part(2), " "), lambda x: x != ""), lambda x: x.cast("int")).alias("templates"))


def judged(readings: DataFrame, key: list[str], model: Model) -> DataFrame:
    """(key, family, probability, family_probability, share, license, confirmed) of readings (key, _words), which have
    different keys; ``family_probability`` is that of the likeliest one but "none".
    ``share`` is the greatest share of a template of the family that the reading holds."""
    grams = readings.select(*key, F.explode(F.array_distinct(hashes_of(F.col("_words")))).alias("gram"))
    table = gram_table(readings.sparkSession, model)
    n = len(model.families)
    sums = (grams.join(F.broadcast(table), "gram").groupBy(*key)
            .agg(*(F.sum(F.get("weights", F.lit(k))).alias(f"_{k}") for k in range(n)), F.flatten(F.collect_list("templates")).alias("_held")))
    logits = F.array(*(F.lit(b) + F.col(f"_{k}") for k, b in enumerate(model.intercepts)))
    e = _let(logits, lambda z: _let(F.array_max(z), lambda m: F.transform(z, lambda x: F.exp(F.greatest(x - m, F.lit(-500.0))))))
    probs = sums.select(*key, "_held", e.alias("_e")).select(
        *key, "_held", F.transform("_e", lambda x: x / F.aggregate("_e", F.lit(0.0), lambda a, y: a + y)).alias("_p"))
    best = probs.select(*key, "_held", F.array_max("_p").alias("probability"),
                         F.array_max(F.slice("_p", 2, n - 1)).alias("family_probability"), F.array_position("_p", F.array_max("_p")).cast("int").alias("_at"))
    templates = _literal([t for t, _ in model.templates], "int"), _literal([len(g) for _, g in model.templates], "int")
    numbers = F.sequence(F.lit(0), F.lit(len(model.templates) - 1))
    shares = F.transform(F.filter(numbers, lambda t: F.get(templates[0], t) == F.col("_at") - 1),
                         lambda t: F.size(F.filter("_held", lambda x: x == t)) / F.get(templates[1], t))
    out = best.select(*key, F.element_at(F.array(*map(F.lit, model.families)), F.col("_at")).alias("family"), "probability", "family_probability",
                      F.when(F.col("_at") > 1, F.coalesce(F.array_max(shares), F.lit(0.0))).otherwise(F.lit(0.0)).alias("share"),
                      (F.col("_at") > 1).alias("license"))
    ok = F.col("license") & (F.col("probability") >= model.accept) & (F.col("share") >= OVERLAP)
    return out.withColumn("confirmed", ok)


def _may_be_license(features: Column, model: Model) -> Column:
    """False only where "none" is the likeliest: a gram adds its greatest lead of a family over "none",
    rounded up, so the sum is no less than the lead of any family."""
    up = lambda x: x + 1e-4 * abs(x) + 1e-6
    none, *others = [[float(f"{w:.6g}") for w in row] for row in model.weights]
    lead = [up(max(column) - n) for n, *column in zip(none, *others)]
    start = up(max(model.intercepts[1:]) - model.intercepts[0])
    return F.aggregate(features, F.lit(start), lambda s, k: s + F.get(_literal(lead), k)) > 0


def _units(docs: DataFrame, model: Model) -> tuple[DataFrame, DataFrame]:
    """(_row, doc_id) of each row, and (_row, _unit, unit) of its paragraphs that may be licenses."""
    paragraphs = paragraphs_of(text_of("text"))
    may = lambda u: F.exists(readings_of(u), lambda x: _may_be_license(features_of(words_of(x), model.grams), model))
    rows = stored(docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", F.filter(paragraphs, may).alias("_units")), "license-units")
    units = rows.where(F.size("_units") > 0).select("_row", F.posexplode("_units").alias("_unit", "unit"))
    return rows.select("_row", "doc_id"), units


def _verdicts(units: DataFrame, model: Model) -> DataFrame:
    """(_row, _unit, _j): the judgements that count of each paragraph that is a license.  That is the whole one if it
    is confirmed, or else those of confirmed lines, or else the first that is a license."""
    readings = units.select("_row", "_unit", F.posexplode(readings_of(F.col("unit"))).alias("_n", "_r")).select(
        "_row", "_unit", "_n", words_of(F.col("_r")).alias("_words"))
    found = judged(readings, ["_row", "_unit", "_n"], model).where("license")
    fields = ("_n", "family", "probability", "share", "confirmed")
    of = found.groupBy("_row", "_unit").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("_j"))
    first = F.get("_j", F.lit(0))
    good = F.filter("_j", lambda j: j["confirmed"])
    return of.withColumn("_j", F.when((first["_n"] == 0) & first["confirmed"], F.slice("_j", 1, 1))
                         .when(F.size(good) > 0, good).otherwise(F.slice("_j", 1, 1)))


def license_paragraphs(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, line, family, probability, share, confirmed) of each judgement that counts; ``line`` is the
    paragraph, its lines separated by spaces."""
    rows, units = _units(docs, model)
    found = _verdicts(units, model).select("_row", "_unit", F.explode("_j").alias("_j"))
    return (units.join(found, ["_row", "_unit"]).join(rows, "_row")
            .select("doc_id", F.translate("unit", JOINT, " ").alias("line"), *(F.col("_j")[c].alias(c) for c in ("family", "probability", "share", "confirmed"))))


def license_report(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, families, n_confirmed, n_unknown) of each row of ``docs``: the confirmed families,
    sorted, and the numbers of confirmed and of unknown license paragraphs."""
    rows, units = _units(docs, model)
    found = _verdicts(units, model).select("_row", F.explode("_j").alias("_j")).groupBy("_row").agg(
        F.array_sort(F.collect_set(F.when(F.col("_j.confirmed"), F.col("_j.family")))).alias("families"),
        F.count_if("_j.confirmed").alias("n_confirmed"), F.count_if(~F.col("_j.confirmed")).alias("n_unknown"))
    whole = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return lookup_join(rows, found, ["_row"]).select(
        "doc_id", F.coalesce("families", F.array().cast("array<string>")).alias("families"), whole("n_confirmed"), whole("n_unknown"))
