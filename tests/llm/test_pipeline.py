"""The pipeline against a brute-force version, stage by stage."""

import hashlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as cp
from test_decontaminate import plain as plain_hits
from test_jaccard import plain as plain_groups
from test_quality import plain as plain_features
from test_repeats import plain as plain_repeats
from llm_fixtures import docs, texts  # noqa: F401

D = "/root/testdata/sf0.001"


def good(text):
    f = plain_features(text)
    n = f["n_words"]
    return not (n < 20 or 100 * f["n_repeat_words"] > 30 * n or 10 * f["n_symbols"] > 3 * n or 10 * f["n_dup_lines"] > 6 * f["n_lines"]
                or 4 * f["n_stutters"] > n or (f["word_chars"] > 12 * n and 2 * f["n_unspaced"] <= f["word_chars"]) or f["word_chars"] < 2 * n)


def plain(docs, items):
    docs = [(i, t) for i, t in docs if good(t)]
    groups, _ = plain_groups(docs)
    docs = [d for k, d in enumerate(docs) if d[0] == min(e[0] for e, g in zip(docs, groups) if g == groups[k])]
    out = []
    for (i, t), spans in zip(docs, plain_repeats([t.encode() for _, t in docs], 240)):
        data, at, left = t.encode(), 0, []
        for a, b in spans:
            left.append(data[at:a])
            at = b
        left = "".join(x.decode("utf-8", "ignore") for x in [*left, data[at:]])
        if not spans or left.strip(" \t\n\x0b\f\r"):
            out.append((i, left))
    out = [d for d in out if next(iter(plain_hits([d], items)))[2] == 0]
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {i: (len(ids := lib.encode(t, add_special_tokens=False).ids),
                hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in out}


def test_run_equals_the_brute_force_version(spark, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in cp.run(spark, D).collect()}
    assert got == plain(list(texts.items()), items)


def test_stages_take_odd_rows_and_keep_the_columns(spark, docs):
    rows = [(None, None), (1, ""), (2, "a few words"), (3, "good words " + " ".join(f"word{k}" for k in range(80)))]
    for df in (docs(rows), docs([])):
        n = df.count()
        for name, stage in cp.STAGES:
            df = stage(spark, df, D)
            if name != cp.STAGES[-1][0]:
                assert df.columns == list(cp.COLUMNS)
        assert [r.doc_id for r in df.collect()] == ([3] if n else [])


def test_clean_documents_pass_unchanged(spark, docs):
    import random
    rnd = random.Random(8)
    rows = [(k, " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 8))) for _ in range(120))) for k in range(30)]
    df = docs(rows)
    for name, stage in cp.STAGES[:-1]:
        df = stage(spark, df, D)
    assert {r.doc_id: r.text for r in df.collect()} == dict(rows)


def test_shared_passages_of_51_to_60_words_go(spark, docs):
    """Passages of over 50 words in otherwise different documents are cut, whatever their place, and
    documents without one stay as they are."""
    import random
    rnd = random.Random(9)
    say = lambda n: " ".join("".join(rnd.choice("abcdefghijklm") for _ in range(rnd.choice([3, 4, 4, 5, 5, 6, 7, 8]))) for _ in range(n))
    passages = [say(n) for n in range(51, 61)]
    rows = [(k, say(90 + k) + " " + passages[k % 10] + "\n" + say(70)) for k in range(40)] + [(100 + k, say(150)) for k in range(40)]
    got = {r.doc_id: r.text for r in cp.suffix_dedup(spark, docs(rows), D).collect()}
    assert got.keys() == dict(rows).keys()
    for k, t in rows:
        if k < 100:
            assert passages[k % 10] not in got[k] and len(got[k]) < len(t) - len(passages[k % 10]) + 12
        else:
            assert got[k] == t
