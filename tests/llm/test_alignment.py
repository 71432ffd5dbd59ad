"""Alignment of two vocabularies against a brute-force version."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cadenza.llm import alignment as al
from cadenza.llm import queries
from cadenza.llm.bpe import byte_letters
from llm_fixtures import docs, texts  # noqa: F401

COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ZEROS = (0, 0, 0, 0, 0, 0, "")


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def tokens(library, text):
    """(ids of A, ids of B) or None, by the libraries over the whole text."""
    a, b = library
    if not text:
        return None
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    letters = byte_letters()
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
               for i in ids_b for p in [b.id_to_piece(i)]]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return None
    return list(zip(ids_a, bytes_a)), list(zip(ids_b, bytes_b))


def brute(library, rows):
    found, pairs = {}, Counter()
    for key, text in enumerate(t for _, t in rows):
        t = tokens(library, text)
        if t is None:
            found[key] = None
            continue
        ends_a, ends_b, at = {}, {}, 0
        for i, x in t[0]:
            at += len(x)
            ends_a.setdefault(at, []).append(i)
        at = 0
        for i, x in t[1]:
            at += len(x)
            ends_b.setdefault(at, []).append(i)
        links = [(i, j) for e in ends_a for i in ends_a[e] for j in ends_b.get(e, [])]
        groups, now_a, now_b = [], [], []
        for e in sorted(ends_a.keys() | ends_b.keys()):
            now_a += ends_a.get(e, [])
            now_b += ends_b.get(e, [])
            if e in ends_a and e in ends_b:
                groups.append(",".join(map(str, now_a)) + "|" + ",".join(map(str, now_b)))
                now_a, now_b = [], []
        found[key] = len(t[0]), len(t[1]), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()
        pairs.update(links)
    most = {}
    for (_, j), n in pairs.items():
        most[j] = max(most.get(j, 0), n)
    out = []
    for key, (doc, _) in enumerate(rows):
        if found[key] is None:
            out.append((doc, *ZEROS))
        else:
            n_a, n_b, n_groups, links, shown = found[key]
            out.append((doc, n_a, n_b, n_groups, len(links), sum(pairs[x] == most[x[1]] for x in links),
                        sum(pairs[x] for x in links), shown))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", *COLUMNS).collect()), key=str)


def odd_rows(texts):
    rnd = random.Random(2)
    odd = " \t\n\r\x0b\x1c\x85\xa0 　  'sdlveAbÉßﬁ½漢字😀́_<|endoftext|><s></s><unk><0x41>9.,"
    rows = [(k, "".join(rnd.choice(odd) for _ in range(rnd.randint(0, 150)))) for k in range(150)]
    rows += [(1000, None), (1001, ""), (1002, " "), (1003, "a▁b"), (1004, "▁"), (1005, "a b"), (1005, "a b"), (None, "a b"),
             (1006, "nul\x00 here"), (1007, "<|endoftext|>"), (1008, "x " * 4000), (1009, "漢字" * 3000), (1010, " " * 500 + "z")]
    return rows + [(2000 + i, t) for i, t in list(texts.items())[:60]] + [(5000 + k, list(texts.values())[0]) for k in range(40)]


@pytest.mark.parametrize("hot", [al.HOT, 200, 0])
def test_against_brute_force(docs, library, texts, hot):
    rows = odd_rows(texts)
    assert got(al.alignment(docs(rows).repartition(4), hot=hot)) == brute(library, rows)


def test_units_give_the_whole_text(library, texts):
    rnd = random.Random(4)
    odd = " \t\n\x85\xa0　  ab'sd漢▁9.,"
    tool = al.Aligner(*al.paths(None, None))
    some = ["".join(rnd.choice(odd) for _ in range(rnd.randint(1, 60))) for _ in range(3000)] + list(texts.values())[:20]
    for t in some:
        assert "".join(" " + u for u in al.units_of(t)) == " " + t
    for _ in range(2):              # learnt, then remembered
        for t, found in zip(some, tool.align(some)):
            want = brute(library, [(0, t)])[0]
            assert (found is None) == (want[1] == 0)
            if found:
                assert (found[0], found[1], len(found[3]), hashlib.sha256(found[2].encode()).hexdigest()) == (*want[1:4], want[-1])


def test_empty_table(docs):
    assert al.alignment(docs([])).collect() == []


def test_query_over_the_whole_table(spark, library):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    df = queries.op13_alignment(spark, sf)
    assert got(df) == brute(library, rows)
    assert df.columns == ["doc_id", *COLUMNS]
