"""Jaccard join against all pairs."""

import random
from collections import Counter

import numpy as np

from cadenza.llm import jaccard_join as jj
from cadenza.llm.components import components
from llm_fixtures import docs, texts  # noqa: F401


def plain(rows):
    """(group, links) of each row by comparing all pairs."""
    sets = []
    for _, t in rows:
        w = jj.words_of(t or "")
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else None)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(rows))], links


def near(rnd, n, edits):
    base = [f"w{rnd.randrange(5000)}" for _ in range(200)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def check(docs, rows, monkeypatch=None):
    groups, links = plain(rows)
    got = jj.near_duplicates(docs(rows)).collect()
    assert Counter((r.doc_id, r.n_links) for r in got) == Counter((i, n) for (i, _), n in zip(rows, links))
    first = {}
    for (i, _), g in zip(rows, groups):
        if i is not None:
            first[g] = min(first.get(g, i), i)
    assert Counter((r.doc_id, r.group_id) for r in got) == Counter((i, first.get(g)) for (i, _), g in zip(rows, groups))
    return groups


def test_links_and_groups_equal_all_pairs(docs, texts):
    rnd = random.Random(2)
    made = near(rnd, 30, 8) + near(rnd, 5, 1) + ["", None, "one", "one", "ONE!", "a b c", "a b c d", "word " * 3000]
    rows = list(enumerate(made + made[:3])) + [(1000 + i, t) for i, t in texts.items()] + [(None, made[0]), (2, made[2])]
    check(docs, rows)


def test_large_groups_are_dealt_into_blocks(docs, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK", 8)
    made = near(random.Random(4), 60, 9)
    check(docs, list(enumerate(made)))


def test_one_of_each_group_stays(docs):
    rnd = random.Random(5)
    made = near(rnd, 12, 2) + near(rnd, 1, 0) + ["", "x", "x"]
    rows = list(enumerate(made)) + [(0, made[0]), (0, "quite another text"), (None, made[-4]), (None, "nothing like it")]
    df = docs(rows)
    kept = jj.one_of_each(df)
    assert kept.columns == df.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    groups, _ = plain(rows)
    empty = {k for k, (_, t) in enumerate(rows) if not t}
    want = {}
    for k, g in enumerate(groups):
        key = "empty" if k in empty else g
        order = (rows[k][0] is None, rows[k][0] or 0)
        if key not in want or order < want[key][0]:
            want[key] = (order, rows[k])
    assert got == Counter(r for _, r in want.values())


def test_empty_table(docs):
    assert jj.near_duplicates(docs([])).count() == 0 and jj.one_of_each(docs([])).count() == 0


def test_pruning_bounds():
    lows = jj.least_matches()
    assert len(lows) == jj.HASHES // jj.STEP and list(lows) == sorted(lows)
    # the bound is where the posterior passes the tolerance: by numerical integration of the Beta density
    n, m = jj.STEP, lows[0]
    x = np.linspace(0, 1, 200001)
    for k, above in ((m, True), (m - 1, False)):
        d = x ** k * (1 - x) ** (n - k)
        assert (d[x >= 0.8].sum() / d.sum() >= jj.TOLERANCE) == above


def test_min_hashes_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 1200, dtype=np.uint64)
    a, b = pool[:1000], pool[200:]
    same = (jj.min_hashes(a, 1024) == jj.min_hashes(b, 1024)).mean()
    assert abs(same - 800 / 1200) < 0.06


def test_components(spark):
    edges = [(1, 2), (3, 2), (5, 4), (4, 4), (7, None), *((k, k + 1) for k in range(20, 60))]
    got = {(r.id, r.root) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), *((k, 20) for k in range(20, 61))}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sets_whose_first_numbers_meet_are_told_apart(spark):
    from cadenza.llm.base import prepare
    prepare(spark)
    rows = spark.createDataFrame([("a", 7, 1), ("b", 7, 1), ("c", 7, -3), ("d", 7, 2), ("e", 8, 5), ("f", None, None)], "doc string, id long, check long")
    got = {r.doc: r.id for r in jj.told_apart(rows).collect()}
    assert got["a"] == got["b"] and got["c"] == 7 and got["e"] == 8 and got["f"] is None
    assert len({got[k] for k in "acde"}) == 4
