"""Packing: every id in one piece, no padding, costs balanced; ids against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cadenza.llm import queries
from cadenza.llm.packing import CAPACITY, LINEAR, Strings, deal, pack
from llm_fixtures import docs, texts  # noqa: F401

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = " \t\n\r\x0b\x0c\x1c\x1d\x85\xa0 　 'sdlveABÉßΣς²½Ⅷ漢字😀́_<|>startoftext|9.,#"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, want, capacity=CAPACITY):
    """``rows``: (doc, doc_tokens, start, sequence, offset, ids); ``want``: ids by doc."""
    by_doc, by_seq = {}, {}
    for doc, total, start, seq, offset, piece in rows:
        assert len(piece) > 0 and total == len(want[doc])
        assert want[doc][start:start + len(piece)] == list(piece)
        by_doc.setdefault(doc, []).append((start, len(piece)))
        by_seq.setdefault(seq, []).append((offset, len(piece)))
    assert by_doc.keys() == want.keys()
    for doc, pieces in by_doc.items():
        at = 0
        for start, n in sorted(pieces):
            assert start == at
            at += n
        assert at == len(want[doc])
    for pieces in by_seq.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= capacity and at & (at - 1) == 0          # full or a power of two: nothing is padded
    return by_seq


def collected(df):
    return [(r.doc_id, r.doc_tokens, r.start, r.sequence_id, r.offset, np.frombuffer(r.ids, "<u4").tolist()) for r in df.collect()]


def test_ids_equal_the_library(library, texts):
    rnd, known = random.Random(3), Strings(PATH)
    odd = ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 120))) for _ in range(400)]
    some = [*odd, "", " ", "<|endoftext|> a<|startoftext|>", "<|startoftext|>", "x" * 3000, *list(texts.values())[:40]]
    for got in (known.encode(pa.array(some)), [known.encode(pa.array([t]))[0] for t in some], known.encode(pa.array(some)[3:])):
        for t, x in zip(some[-len(got):], got):
            assert np.frombuffer(x, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t[:80])


def test_forgetting_changes_no_ids(library, texts, monkeypatch):
    from cadenza.llm import packing
    monkeypatch.setattr(packing, "KNOWN", 40)
    known, some = Strings(PATH), list(texts.values())[:30] * 2
    for t in some:
        assert np.frombuffer(known.encode(pa.array([t]))[0], "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
    assert known.older


@pytest.mark.parametrize("capacity", [1, 8, 64, 2048])
def test_deal_holds_each_token_once(capacity):
    rnd = random.Random(capacity)
    for _ in range(40):
        lengths = [rnd.choice([1, 2, capacity, capacity + 1, rnd.randint(1, 5 * capacity)]) for _ in range(rnd.randint(0, 60))]
        want = {d: list(range(d * 10 ** 6, d * 10 ** 6 + n)) for d, n in enumerate(lengths)}
        rows = [(d, lengths[d], a, s, o, want[d][a:a + n]) for d, a, n, s, o in deal(lengths, capacity)]
        sizes = [sum(n for _, n in p) for p in check(rows, want, capacity).values()]
        short = [n for n in sizes if n < capacity]
        assert len(short) == len(set(short))                  # a sequence for each power of two at most


def test_each_piece_goes_to_the_cheapest_sequence_with_room():
    """The rule itself, replayed over the remainders that were placed whole."""
    rnd = random.Random(5)
    lengths = [rnd.randint(1, 500) for _ in range(300)]
    rows = [r for r in deal(lengths, 512)]
    total = sum(lengths)
    sizes = [512] * (total // 512) + [1 << k for k in range(9, -1, -1) if total % 512 >> k & 1]
    room, cost, last = list(sizes), [0] * len(sizes), 10 ** 9
    for d, start, n, k, _ in rows:
        if n != lengths[d]:
            break
        assert n <= last
        last = n
        assert cost[k] == min(c for c, r in zip(cost, room) if r >= n)
        room[k] -= n
        cost[k] += LINEAR * n + n * n
    in_order = sum(1 for d, _, n, _, _ in rows if n == lengths[d])
    assert in_order > 0.9 * len(lengths)                      # few documents are cut


def test_balance():
    """Attention costs of full sequences lie closer together than those of filling sequence by sequence in
    descending order."""
    rnd = random.Random(7)
    lengths = [rnd.randint(1, 700) for _ in range(3000)]
    by_seq = {}
    for _, _, n, k, _ in deal(lengths):
        by_seq.setdefault(k, []).append(n)
    dealt = [sum(n * n for n in p) for p in by_seq.values() if sum(p) == CAPACITY]
    plain, at = [0], 0
    for n in sorted(lengths, reverse=True):
        while n:
            part = min(n, CAPACITY - at)
            plain[-1] += part * part
            n, at = n - part, at + part
            if at == CAPACITY:
                plain.append(0)
                at = 0
    assert np.std(dealt) < 0.3 * np.std(plain[:-1])


def test_operator(docs, library, texts):
    rows = [(i, t) for i, t in texts.items()] + [(10 ** 6, None), (10 ** 6 + 1, ""), (10 ** 6 + 2, "word " * 60000), (10 ** 6 + 3, " \n ")]
    want = {i: ids(library, t) for i, t in rows}
    df = docs(rows).repartition(3).cache()
    check(collected(pack(df)), want)
    check(collected(pack(df, run=5000)), want)
    check(collected(pack(df, capacity=256)), want, 256)


def test_edges(docs, library):
    assert pack(docs([])).collect() == []
    same = collected(pack(docs([(1, "a b"), (1, "a b"), (None, "a b")]).coalesce(1)))
    assert sum(len(r[5]) for r in same) == 3 * len(ids(library, "a b"))
    with pytest.raises(ValueError):
        pack(docs([]), capacity=1000)


def test_query_over_the_whole_table(spark, library):
    sf = "/root/testdata/sf0.001"
    got = queries.op11_packing(spark, sf).collect()
    table = {r.doc_id: ids(library, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = []
    for r in got:
        piece = table[r.doc_id][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())
        rows.append((r.doc_id, r.doc_tokens, r.start, r.sequence_id, r.offset, piece))
    check(rows, table)
    assert [f.dataType.simpleString() for f in queries.op11_packing(spark, sf).schema] == ["bigint"] * 7
