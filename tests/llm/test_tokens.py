"""Token counts and BPE against the tokenizers library."""

import random
import struct

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cadenza.llm import bpe
from cadenza.llm.pretokens import SPECIAL, pieces
from cadenza.llm.token_counts import spliced, token_counts
from llm_fixtures import docs, texts  # noqa: F401

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = " \t\n\r\x0b\x1c\x85\xa0  'sdlvetmAbÉß²½१Ⅷ漢字😀́_<|>endoftext|9.,!?#​"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    merge = bpe.Merger(PATH)
    words = [b" the", b"the", b" of", b"Hello", b" world", "é".encode(), b" then", b" there", b"\n"]
    return bpe.Encoder(PATH, bpe.compile_lexicon(words, merge))


def odd_texts():
    rnd = random.Random(1)
    out = ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 200))) for _ in range(300)]
    return out + ["", SPECIAL, f"a{SPECIAL} b{SPECIAL}{SPECIAL}|", " " * 3000 + "x", "x" * 2500, "ab" * 1500, "a\n" * 900]


def ids_of(encoder, text):
    return list(memoryview(encoder.encode(text)).cast("I"))


def test_ids_and_text_equal_the_library(library, encoder, texts):
    for t in [*odd_texts(), *list(texts.values())[:40]]:
        want = library.encode(t, add_special_tokens=False).ids
        assert ids_of(encoder, t) == want, repr(t[:80])
        assert encoder.decode(encoder.encode(t)) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=150, deadline=None, derandomize=True)
@given(st.text(alphabet=st.one_of(st.sampled_from(ODD), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(text):
    merge = bpe.Merger(PATH)
    enc = test_any_text.__dict__.setdefault("enc", bpe.Encoder(PATH, bpe.compile_lexicon([b"a"], merge)))
    lib = test_any_text.__dict__.setdefault("lib", Tokenizer.from_file(PATH))
    assert ids_of(enc, text) == lib.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("chunk,overlap", [(64, 8), (200, 20), (1 << 16, 256)])
def test_spliced_chunks_are_the_whole_text(chunk, overlap, texts):
    for t in [*odd_texts(), *list(texts.values())[:15]]:
        assert [p for part in spliced(t, chunk, overlap) for p in part] == pieces(t)


def test_chunks_stay_bounded():
    t = "word and word, " * 20000
    assert max(sum(map(len, part)) for part in spliced(t, 4096, 64)) <= 4096 + 64


def test_long_words_merge_like_short_ones(encoder):
    merge = encoder.merge
    for w in (b"a" * 200, b"the" * 40, bytes(range(33, 120)) * 3):
        ids = [merge.id_of_byte[b] for b in w]
        assert merge._long(list(ids)) == merge._short(list(ids))


def test_lexicon_is_exact_and_minimal():
    merge = bpe.Merger(PATH)
    words = [b"walking", b"talking", b"walked", b"talked", b"walks", b"talks", b"", b"w"]
    tables = bpe.compile_lexicon(words, merge)
    lex = bpe.Lexicon(tables)
    assert [lex.number(w) for w in sorted(words)] == list(range(len(words)))
    for w in words:
        assert list(memoryview(lex.get(w)).cast("I")) == merge(w)
    for w in (b"walk", b"talkin", b"walkings", b"x"):
        assert lex.get(w) is None
    # no two states accept the same rest: walk- and talk- share theirs
    states, arcs = struct.unpack_from("<2I", tables)
    assert states < sum(map(len, words)) / 2 and arcs < 20


def test_counts_of_odd_rows(spark, docs, library):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (4, "long word " * 30000), (5, SPECIAL)]
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts(docs(rows)).collect()), key=str)
    want = sorted(((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows), key=str)
    assert got == want
    assert token_counts(docs([])).count() == 0


def test_encode_decode_of_odd_rows(spark, docs, library):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "the c"), (4, "long word " * 20000), (5, f"x{SPECIAL}")]
    got = sorted(((r.doc_id, list(memoryview(bytes(r.ids)).cast("I")), r.decoded) for r in bpe.encode_decode(docs(rows)).collect()), key=str)
    assert got == sorted(((i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in rows), key=str)
    assert bpe.encode_decode(docs([])).count() == 0


def test_frequent_words_are_bounded(docs):
    words = bpe.frequent_words(docs([(1, "a a a a b b b b c c d")]), 3)
    assert len(words) <= 3 and b" b" in words
