"""CRF marginals against all labellings; held-out accuracy."""

import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cadenza.llm import toxic_spans as t
from llm_fixtures import docs, texts  # noqa: F401


@pytest.fixture(scope="module")
def chain():
    rnd, rows = random.Random(0), []
    for _ in range(200):
        s = [rnd.choice(["a", "b", "c", "idiot", "clown"]) for _ in range(rnd.randint(1, 30))]
        rows.append((s, [int(w in ("idiot", "clown")) for w in s]))
    return t.fit_chain(rows, {"=idiot": 3.0, "=clown": 3.0, "idio*": 2.0})


@pytest.mark.parametrize("tokens", [["a"] * 5 + ["idiot"] + ["b"] * 4, ["idiot"], ["a", "clown", "idiot"], ["clown"] + ["a"] * 8, ["a", "b"], []])
def test_marginals_equal_all_labellings(chain, tokens):
    e = [chain.bias + (chain.emission(w) or 0.0) for w in tokens]
    total, marked = 0.0, [0.0] * len(tokens)
    for y in itertools.product((0, 1), repeat=len(tokens)):
        p = math.exp(sum(x for x, k in zip(e, y) if k) + sum(chain.moves[a, b] for a, b in zip(y, y[1:])))
        total += p
        for k, v in enumerate(y):
            marked[k] += v * p
    got = t.Tagger(chain).marginals(tokens)
    assert [k for k, _ in got] == [k for k, w in enumerate(tokens) if chain.emission(w) is not None]
    for k, p in got:
        assert p == pytest.approx(marked[k] / total, abs=1e-9)


def test_fit_separates(chain):
    tag = t.Tagger(chain).tag
    score, spans = tag("A, idiot! b clown")
    assert score > 0.9 and spans == [(3, 8), (12, 17)]
    assert tag("a b c") == (0.0, []) and tag("") == (0.0, [])


def test_long_text_is_scored_whole(chain):
    score, spans = t.Tagger(chain).tag("a " * 200000 + "clown")
    assert score > 0.9 and spans == [(400000, 400005)]


def test_odd_rows(spark, docs, chain):
    rows = [(1, None), (2, ""), (None, "clown"), (3, "a clown"), (3, "a clown")]
    got = Counter((r.doc_id, round(r.score, 9), len(r.spans)) for r in t.toxic_spans(docs(rows), chain).collect())
    tag = t.Tagger(chain).tag
    assert got == Counter((i, round(tag(x or "")[0], 9), len(tag(x or "")[1])) for i, x in rows)
    assert t.toxic_spans(docs([]), chain).count() == 0


def test_training_without_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = t.train(docs([(1, "a b")]), none)
    assert t.toxic_spans(docs([(1, "a b")]), model).first().score == 0.0


def test_held_out_documents(spark):
    from cadenza.llm.queries import op8_toxic_spans
    d = "/root/testdata/sf0.1"
    rows = (op8_toxic_spans(spark, d).where("held_out").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
            .groupBy("toxic", "predicted").count().collect())
    n = {(r.toxic, r.predicted): r["count"] for r in rows}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.8 and n.get((0, 1), 0) / (n[0, 0] + n.get((0, 1), 0)) < 0.04


def test_labels_ids_and_sources_are_no_inputs(spark, docs, chain):
    a = t.toxic_spans(docs([(1, "a clown b")]), chain).first().score
    b = t.toxic_spans(docs([(77, "a clown b")]).withColumn("source", F.lit("other")), chain).first().score
    assert a == b
