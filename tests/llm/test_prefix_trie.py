"""Prefix trie and its rollup against a brute-force version."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cadenza.llm import prefix_trie as pt
from cadenza.llm import queries
from cadenza.llm.base import prepare

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            convs.setdefault(c, []).append((turn is not None, turn or 0, mark, role, text))
    convs = {c: [(x[3], x[4]) for x in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(convs.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + own[h:])
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, who in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(who) - 1) * words
    out = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if rebuilt[c] == node)
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(children.get(node, [])),
                    leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture
def make(spark):
    prepare(spark)

    def frame(rows):
        df = spark.createDataFrame(rows, SCHEMA)
        for name in ("node", "parent", "depth", "part", "place", "t", "words", "n", "h", "_salt"):
            df = df.withColumn(name, F.lit("x"))
        return df
    return frame


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def some_rows(seed, convs=120, texts=3, longest=9):
    rnd = random.Random(seed)
    say = ["", None, "a", "b c", " d\te \n f", "é x", "0:a"][:texts]
    out = []
    for c in rnd.sample(range(-5 if seed % 2 else 0, 300), convs):
        for k in range(rnd.randint(1, longest)):
            out.append((c, rnd.choice([k, k, k, None]), rnd.choice(["user", "assistant", None, ""]) if seed % 3 else "user", rnd.choice(say)))
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("seed,small", [(1, pt.SMALL), (2, 40), (3, 1), (6, 3)])
def test_against_brute_force(make, seed, small):
    rows = some_rows(seed, texts=7 if seed % 3 else 3)
    assert got(pt.prefix_trie(make(rows).repartition(4), small)) == brute(rows)


def test_long_and_hot_conversations(make):
    """One conversation of a third of all rows, many copies of another, and turns that repeat."""
    rows = [(7, k, "user", f"w{k % 5} x") for k in range(700)] + [(9, 3, "user", "same")] * 300
    rows += [(c, k, "user", f"hello {k}") for c in range(20, 320) for k in range(3)] + [(c, 0, "bot", "only") for c in range(400, 460)]
    assert got(pt.prefix_trie(make(rows).repartition(3), 64)) == brute(rows)


def test_a_path_takes_few_rounds(make, monkeypatch):
    rounds = []
    real = pt.stored
    monkeypatch.setattr(pt, "stored", lambda df, name: (rounds.append(name), real(df, name))[1])
    rows = [(0, k, "user", "x") for k in range(600)]
    assert got(pt.prefix_trie(make(rows), 40)) == brute(rows)
    assert rounds.count("trie-moved") <= 6          # 600 rows, halved down to 40 and less


def test_edges(make):
    assert pt.prefix_trie(make([])).collect() == []
    rows = [(None, 0, "user", "x"), (None, None, None, None)]
    assert pt.prefix_trie(make(rows)).collect() == []
    # conversation 43 of one turn, whose block has no first conversation, may have no turn left
    for rows in ([(43, 0, "user", "x")], [(c, None, None, None) for c in range(1, 19)], [(5, 1, "a", "x " * 20000)] * 3):
        assert got(pt.prefix_trie(make(rows))) == brute(rows)


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = queries.op12_prefix_trie(spark, sf)
    assert got(df) == brute(rows)
    assert df.columns == COLUMNS
