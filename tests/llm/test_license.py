"""License scan: families, unknown notices, sentences that only sound alike."""

from collections import Counter

import pytest

from cadenza.llm import license_scan as ls
from llm_fixtures import docs, texts  # noqa: F401


@pytest.fixture(scope="module")
def model(spark):
    from cadenza.llm.base import prepare
    prepare(spark)
    return ls.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_templates_are_confirmed(docs, model):
    rows = [(k, x) for k, (f, xs) in enumerate(sorted(ls.TEMPLATES.items())) for x in xs]
    fams = sorted(ls.TEMPLATES)
    got = ls.license_report(docs([(k, f"Some text.\nAs said: {x.lower()}\nMore.") for k, x in rows]), model).collect()
    right = sum(r.families == [fams[r.doc_id]] for r in got)
    assert right >= 0.9 * len(rows)


def test_sentences_that_sound_alike_are_none(docs, model):
    got = ls.license_report(docs(list(enumerate([*ls.SOUNDALIKES, "Nothing here."]))), model).collect()
    assert all(r.families == [] for r in got) and sum(r.n_unknown for r in got) <= 2


def test_strangers_are_not_confirmed(docs, model):
    new = ["Licensed under the Walnut Data License, version 2.", "Released under the Maple Group Licence.", *ls.STRANGERS]
    got = ls.license_report(docs(list(enumerate(new))), model).collect()
    assert sum(r.n_confirmed for r in got) <= 1 and sum(r.n_unknown for r in got) >= len(new) // 2


def test_table_lines(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = Counter()
    marks = {"CC BY-NC 4.0": "CC-BY-NC", "GNU General Public": "GPL", "Apache License": "Apache", "MIT License": "MIT",
             "All rights reserved": "Proprietary"}
    for r in docs.collect():
        want[r.doc_id] = tuple(sorted({f for m, f in marks.items() if m in r.text}))
    got = {r.doc_id: tuple(r.families) for r in ls.license_report(docs, model).collect()}
    assert got == dict(want)


def test_paragraphs_agree_with_the_report(spark, docs, model):
    df = docs([(1, "x\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License."), (2, None), (3, "")], extra=False)
    found = {(r.doc_id, r.family, r.confirmed) for r in ls.license_paragraphs(df, model).collect()}
    assert found == {(1, "CC-BY-NC", True), (1, "MIT", True)}


def test_odd_rows(docs, model):
    rows = [(1, None), (2, ""), (None, "All rights reserved."), (3, "Released under the MIT License."), (3, "Released under the MIT License."),
            (4, "word " * 100000 + "\nAll rights reserved.")]
    got = Counter((r.doc_id, tuple(r.families), r.n_confirmed) for r in ls.license_report(docs(rows), model).collect())
    assert got == Counter({(1, (), 0): 1, (2, (), 0): 1, (None, ("Proprietary",), 1): 1, (3, ("MIT",), 1): 2, (4, ("Proprietary",), 1): 1})
    assert ls.license_report(docs([]), model).count() == 0


def test_plan_is_native(docs, model):
    plan = ls.license_report(docs([(1, "x")]).select("doc_id", "text"), model)._jdf.queryExecution().optimizedPlan().toString()
    assert "python" not in plan.lower() and "arrow" not in plan.lower()


WRAPPED = {
    "GPL": """// This program is free software: you can redistribute it and/or modify
// it under the terms of the GNU General Public License as published by
// the Free Software Foundation, either version 3 of the License, or
// (at your option) any later version.""",
    "BSD": """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions are
 * met:
 *
 * 1. They stay the same.""",
    "MPL": """# This Source Code Form is subject to the terms of the Mozilla Public
# License, v. 2.0. If a copy of the MPL was not distributed with this
# file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "MIT": """    Permission is hereby granted, free of charge, to any person
    obtaining a copy of this software and associated documentation
    files (the "Software"), to deal in the Software without restriction,""",
}


def test_wrapped_notices_are_confirmed(docs, model):
    rows = [(k, f"First words.\n\n{WRAPPED[k]}\n\nLast words.".replace("\n", end)) for k in WRAPPED for end in ("\n", "\r\n")]
    got = ls.license_report(docs([(n, x) for n, (_, x) in enumerate(rows)]), model).collect()
    assert {r.doc_id: (r.families, r.n_confirmed) for r in got} == {n: ([k], 1) for n, (k, _) in enumerate(rows)}


def test_one_line_notices_stay_paragraphs(docs, model):
    lines = ["Licensed under CC BY-NC 4.0", "Released under the MIT License", "SPDX-License-Identifier: BSD-3-Clause",
             "This work is licensed under the GNU General Public License, version 3.", "All rights reserved."]
    got = ls.license_report(docs([(1, "\n".join(lines))]), model).first()
    assert (got.families, got.n_confirmed) == (["BSD", "CC-BY-NC", "GPL", "MIT", "Proprietary"], 5)


FORMS = {"Available under CC-BY-SA-4.0": "CC-BY-SA", "Distributed under GPLv3": "GPL", "Apache-2.0": "Apache", "Code: MPL-2.0": "MPL",
         "Available under CC-BY-4.0": "CC-BY", "Distributed under LGPLv3": "LGPL", "Distributed under GPL-2.0-only": "GPL",
         "Terms: BSD-3-Clause": "BSD", "Available under CC-BY-NC-4.0.": "CC-BY-NC", "SPDX-License-Identifier: GPL-3.0-or-later": "GPL",
         "This Source Code Form is subject to the terms of the Mozilla Public": "MPL", "Distributed under AGPLv3": "AGPL"}


def test_forms_without_a_cue(docs, model):
    got = {r.doc_id: r for r in ls.license_report(docs(list(enumerate(FORMS))), model).collect()}
    assert {x: got[k].families for k, x in enumerate(FORMS)} == {x: [f] for x, f in FORMS.items()}


def test_the_early_verdict_loses_nothing(spark, docs, model):
    from pyspark.sql import functions as F
    lines = [*FORMS, *ls.STRANGERS, *ls.SOUNDALIKES, *(x for xs in ls.TEMPLATES.values() for x in xs)]
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.explode(ls.paragraphs_of("text")).alias("text"))
    b = (docs(list(enumerate(lines))).select("text").unionByName(table).distinct()
         .select("text", ls.words_of(F.col("text")).alias("_words")))
    may = {r.text: r.may for r in b.select("text", ls._may_be_license(ls.features_of(F.col("_words"), model.grams), model).alias("may")).collect()}
    found = {r.text: r for r in ls.judged(b, ["text"], model).collect()}
    assert not [t for t, r in found.items() if r.license and not may[t]]
    assert sum(not x for x in may.values()) > len(may) // 4


def test_every_gram_of_the_templates_has_its_place(model):
    assert len(set(model.grams)) == len(model.grams)
    assert len(model.templates) == sum(map(len, ls.TEMPLATES.values()))


def test_against_a_plain_version(spark, model):
    """Judgements of all lines of a table and of the templates, by the model's weights in plain Python."""
    import math

    from pyspark.sql import functions as F
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.explode(F.split("text", "\n")).alias("text"))
    fixed = spark.createDataFrame([(x,) for x in [*FORMS, *ls.STRANGERS, *(x for xs in ls.TEMPLATES.values() for x in xs), "", "MIT " * 3000]], "text string")
    lines = table.where("rand(1) < 0.2").unionByName(fixed).distinct().cache()
    hashed = lines.select("text", ls.words_of(F.col("text")).alias("_words")).select("text", "_words", F.array_distinct(ls.hashes_of(F.col("_words"))).alias("g"))
    rows = hashed.collect()
    got = {r.text: r for r in ls.judged(hashed.select("text", "_words"), ["text"], model).collect()}
    at = {g: k for k, g in enumerate(model.grams)}
    known = at.keys() | {g for _, gs in model.templates for g in gs}
    for r in rows:
        held = set(r.g)
        if not held & known:
            assert r.text not in got
            continue
        z = [b + sum(float(f"{w[at[g]]:.6g}") for g in held if g in at) for w, b in zip(model.weights, model.intercepts)]
        p = [math.exp(x - max(z)) for x in z]
        p = [x / sum(p) for x in p]
        k = p.index(max(p))
        share = max((len(held.intersection(gs)) / len(gs) for f, gs in model.templates if f == k), default=0.0) if k else 0.0
        x = got[r.text]
        assert x.family == model.families[k] and abs(x.probability - p[k]) < 1e-9 and abs(x.share - share) < 1e-12
        assert x.license == (k > 0) and x.confirmed == (k > 0 and p[k] >= model.accept and share >= ls.OVERLAP)


def test_no_plan_holds_the_sample(docs):
    lines = ls.training_lines(docs([(1, "A markedword stands in this line of the corpus.\nAnd here."), (2, None)]))
    assert "markedword" not in lines._jdf.queryExecution().toString()
    assert any("markedword" in r.words for r in lines.collect())
