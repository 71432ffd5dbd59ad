"""Suffix-array dedup against counting all strings."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cadenza.llm import repeated_spans as rs
from llm_fixtures import docs, texts  # noqa: F401


def plain(texts, length=400):
    seen = Counter(t[p:p + length] for t in texts for p in range(len(t) - length + 1))
    return [rs.merged([(p, p + length) for p in range(len(t) - length + 1) if seen[t[p:p + length]] > 1]) for t in texts]


def test_orders_are_sorted():
    rnd = random.Random(3)
    for _ in range(200):
        base = bytes(rnd.choice(b"ab") for _ in range(60))
        s = [base[:rnd.randint(0, 60)] + bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 30))) for _ in range(rnd.randint(1, 40))]
        for order in (rs.suffix_order(s), rs.suffix_order(s, 8), rs.blind_trie_order(list(range(len(s))), s)):
            assert [s[i] for i in order] == sorted(s) and sorted(order) == list(range(len(s)))


def test_common_prefix():
    assert rs.common(b"abc", b"abd") == 2 and rs.common(b"", b"x") == 0 and rs.common(b"ab", b"abc") == 2


def test_equal_windows_have_equal_anchors(texts):
    data = [t.encode() for t in texts.values()][:30]
    rows, anchor, first, last, gram = rs.blocks_of(data)
    assert sum(last - first + 1) == sum(max(0, len(t) - 399) for t in data)     # each window once
    where = {}
    for r, a, p, q, g in zip(rows.tolist(), anchor.tolist(), first.tolist(), last.tolist(), gram.tolist()):
        for w in range(p, q + 1):
            assert 0 <= a - w <= 400 - rs.GRAM
            assert where.setdefault(data[r][w:w + 400], (a - w, g)) == (a - w, g)


def mixed(rnd):
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 8))) for _ in range(300)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    shared, long = [prose(120) for _ in range(6)], prose(400)

    def edited(t):
        t = list(t)
        for _ in range(rnd.randint(0, 3)):
            t[rnd.randrange(len(t))] = rnd.choice("xyzé")
        return "".join(t)
    out = [f"{prose(rnd.randint(0, 200))} {rnd.choice(shared)} {prose(rnd.randint(0, 100))}" for _ in range(40)]
    out += [edited(long) for _ in range(20)] + [long] * 4 + ["a" * 1500, "ab" * 700, "a" * 399, "a" * 400, "", "é" * 450, prose(900) * 2]
    return out + [shared[0][:rnd.randint(300, len(shared[0]))] + prose(50) for _ in range(25)]


@pytest.mark.parametrize("crowd", [2048, 3])
def test_spans_equal_the_plain_version(docs, crowd):
    made = mixed(random.Random(crowd))
    rows = list(enumerate(made)) + [(None, None), (None, made[0]), (5, made[5])]
    want = Counter()
    for (i, t), spans in zip(rows, plain([(t or "").encode() for _, t in rows])):
        data = (t or "").encode()
        left, at = b"", 0
        for a, b in spans:
            left, at = left + data[at:a], b
        left += data[at:]
        want[i, len(data), tuple(spans), hashlib.sha256(left).hexdigest()] += 1
    got = rs.without_repeats(docs(rows), crowd=crowd).select("doc_id", "n_bytes", "removed", F.sha2("kept", 256).alias("k")).collect()
    assert Counter((r.doc_id, r.n_bytes, tuple((x.start, x.stop) for x in r.removed), r.k) for r in got) == want


def test_whole_table(spark, texts):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: [(x.start, x.stop) for x in r.removed] for r in rs.without_repeats(df, columns=["doc_id"]).collect()}
    assert got == dict(zip(texts, plain([t.encode() for t in texts.values()])))


def test_kept_text_has_no_broken_characters(docs):
    part = "é" * 300
    rows = [(1, "x" + part + "yy"), (2, part + "z"), (3, None)]
    for r in rs.without_repeats(docs(rows)).collect():
        assert "�" not in r.kept_text and len(bytes(r.kept)) + sum(x.stop - x.start for x in r.removed) == r.n_bytes


def test_query_cuts_passages_of_400_bytes_and_no_shorter_ones(spark, docs, tmp_path):
    """Passages of over 50 words go by their bytes, not their words; n_bytes counts the whole text."""
    from cadenza.llm.queries import op1_suffix_dedup
    rnd = random.Random(12)
    say = lambda n: " ".join("".join(rnd.choice("abcdefghijklm") for _ in range(rnd.choice([3, 4, 4, 5, 5, 6, 7, 8]))) for _ in range(n))
    passages = [say(n) for n in (51, 55, 60)] + [say(100)[:399 - 2], say(100)[:400 - 2], say(100)]
    # other letters on both sides: exactly the passage and a space on each side are shared
    rows = [(10 * k + i, "nopqrstuvw"[i] * 9 + f" {x} " + "QRSTUVWXYZ"[i] * 9) for k, x in enumerate(passages) for i in range(4)]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    want = {}
    for (i, t), spans in zip(rows, plain([t.encode() for _, t in rows])):
        left = "".join(t[a:b] for a, b in zip([0, *(b for _, b in spans)], [*(a for a, _ in spans), len(t)]))
        want[i] = (len(t), sum(b - a for a, b in spans), len(spans), hashlib.sha256(left.encode()).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op1_suffix_dedup(spark, str(tmp_path)).collect()}
    assert got == want
    assert [len(x.split()) > 50 and len(x) + 2 < 400 for x in passages[:3]] == [True] * 3
    assert [got[10 * k][1] for k in range(6)] == [0, 0, 0, 0, 400, len(passages[5]) + 2]


def test_empty_table(docs):
    assert rs.without_repeats(docs([])).count() == 0
