"""Quality features and cascade against a plain version."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cadenza.llm import quality_rules as q
from llm_fixtures import docs, texts  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def plain(text):
    w = WORD.findall(text or "")
    n = len(w)
    grams = [tuple(w[i:i + 8]) for i in range(n - 7)]
    count, cover = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            cover.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return dict(n_words=n, word_chars=sum(map(len, w)), n_symbols=sum((text or "").count(c) for c in "#*$%&|<>"),
                n_lines=len(lines), n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(cover),
                n_stutters=sum(a == b for a, b in zip(w, w[1:])), n_unspaced=len(UNSPACED.findall(text or "")))


CASES = [None, "", " \n\t ", "one", "a " * 30, "x y z\nx y z\n\nx y z", "# * $ % & | < >", "é 漢字 \x0b\x0c\r b",
         " ".join(f"w{k % 9}" for k in range(60)), " ".join(f"w{k}" for k in range(20000)),
         "a b c d e f g h i a b c d e f g h", "lead " + "p q r s t u v w " * 3 + "tail"]


def test_features_equal_the_plain_version(spark, docs, texts):
    rows = [*enumerate(CASES), *((100 + i, t) for i, t in texts.items()), (100, texts[min(texts)])]
    got = q.quality_report(docs(rows)).collect()
    want = Counter((i, tuple(sorted(plain(t).items()))) for i, t in rows)
    assert Counter((r.doc_id, tuple((k, r[k]) for k in sorted(q.FEATURES))) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (r.rejected_by is None) and not (r.base_failed and r.kept)


def test_long_words_go_but_not_in_scripts_without_spaces(spark, docs):
    line = "今日は朝から雨が降っていたので家で本を読んで過ごしました{}。"
    thai = "วันนี้ฝนตกตั้งแต่เช้าจึงอยู่บ้านอ่านหนังสือ{}"
    rows = [(1, "\n".join(line.format(chr(0x4e00 + k)) for k in range(30))), (2, "\n".join(thai.format(k) for k in range(30))),
            (3, " ".join(f"{k}" * 9 + "abcdefgh" for k in range(10, 40))), (4, " ".join("𠀀" * 14 + f"{k}" for k in range(30))),
            (5, " ".join(f"word{k}" for k in range(30)) + " 今日は")]
    report = {r.doc_id: (r.kept, r.rejected_by) for r in q.quality_report(docs(rows)).collect()}
    assert report == {1: (True, None), 2: (True, None), 3: (False, "word_length"), 4: (True, None), 5: (True, None)}
    assert {r.doc_id for r in q.keep_good(docs(rows)).collect()} == {1, 2, 4, 5}


def test_cascade_keeps_what_the_report_keeps(spark, docs, texts):
    df = docs([*((i, t) for i, t in texts.items()), (None, None), (1, "")])
    kept = q.keep_good(df)
    assert kept.columns == df.columns
    want = Counter(r.doc_id for r in q.quality_report(df).where("kept").collect())
    assert Counter(r.doc_id for r in kept.collect()) == want


def test_empty_table(docs):
    assert q.keep_good(docs([])).count() == 0 and q.quality_report(docs([])).count() == 0


def test_order_is_by_rejections_per_second(docs, texts):
    found = q.measured(docs(list(texts.items())))
    gains = [share / seconds for _, seconds, share in found]
    assert gains == sorted(gains, reverse=True) and {n for n, _, _ in found} == {r.name for r in q.RULES}


def test_order_does_not_change_the_verdict(docs, texts):
    df = docs(list(texts.items()))
    a = {r.doc_id for r in q.keep_good(df, q.RULES).select("doc_id").collect()}
    b = {r.doc_id for r in q.keep_good(df, q.RULES[::-1], sample=3).select("doc_id").collect()}
    assert a == b


@pytest.mark.parametrize("build", [q.keep_good, q.quality_report])
def test_plans_are_native(docs, texts, build):
    plan = build(docs(list(texts.items())))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_clean_documents_of_good_quality_stay(spark):
    d = "/root/testdata/sf0.01"
    report = q.quality_report(spark.read.parquet(f"{d}/documents.parquet"))
    labels = spark.read.parquet(f"{d}/labels.parquet")
    n = report.join(labels, "doc_id").where(~F.col("base_failed")).groupBy("quality", "kept").count().collect()
    by = {(r.quality, r.kept): r["count"] for r in n}
    assert by.get((1, False), 0) == 0 and by.get((0, True), 0) <= 0.1 * by.get((0, False), 1)
