"""Quality rules as a short-circuit cascade, in native expressions only.

Every rule has a rejecting condition over features of the text.  On a bounded
sample (``SAMPLE`` rows; it only sets the order, never the verdict) each rule's
cost and share of rejections are measured, and the rules are applied in the order
of rejections per cost.  Filters follow each other, so a row that one rule rejects
costs nothing in the later ones.

Words are runs of anything but space, tab and the line breaks of ASCII.  NULL and
empty texts have no words and are rejected (under 20 words).  Repeated rows get
equal verdicts; documents' other columns pass through.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import few_texts, stored, text_of

SAMPLE = 400           # rows on which the order is estimated ...
SAMPLE_CHARS = 1 << 14 # ... each of at most so many characters
WINDOW = 8
_SPACE = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"
# code points of scripts that write no spaces between words: Thai, Lao, Burmese, Khmer, kana, Han
_UNSPACED = r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]"


# --- features ------------------------------------------------------------------------------

def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+", -1), "")


def _lines(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, _SPACE, "") != "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _window_hashes(words: Column) -> Column:
    """64-bit hashes of the 8-word windows, by doubling: 1, 2, 4, 8 words."""
    def double(h: Column, span: int) -> Column:
        m = F.greatest(F.size(h) - span, F.lit(0))
        twice = F.zip_with(F.slice(h, F.lit(1), m), F.slice(h, F.lit(1 + span), m), lambda x, y: F.xxhash64(x, y))
        return twice if 2 * span == WINDOW else _let(twice, lambda g: double(g, 2 * span))
    return _let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: double(h, 1))


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more: equal hashes meet after a sort, and
    their positions, sorted, each add the words not covered by the one before."""
    def places(s: Column) -> Column:
        m = F.greatest(F.size(s) - 1, F.lit(0))
        pairs = F.zip_with(F.slice(s, F.lit(1), m), F.slice(s, F.lit(2), m),
                           lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
        return F.array_sort(F.array_distinct(F.flatten(pairs)))
    at = _let(F.array_sort(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), places)
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last"))
    total = F.aggregate(at, start, lambda acc, i: F.struct(
        (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")))
    return total["n"]


def _repeats(hashes: Column) -> Column:
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _covered(hashes)).otherwise(F.lit(0).cast("bigint"))


def _stutters(words: Column) -> Column:
    m = F.greatest(F.size(words) - 1, F.lit(0))
    same = F.zip_with(F.slice(words, F.lit(1), m), F.slice(words, F.lit(2), m), lambda x, y: x == y)
    return F.size(F.filter(same, lambda x: x)).cast("bigint")


def _repeated_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")


def n_words(text: Column) -> Column:
    return F.size(words_of(text)).cast("bigint")


def _count(text: Column, chars: str) -> Column:
    """Occurrences of ASCII characters; replacing a character that is absent only searches bytes."""
    n = F.lit(0)
    for c in chars:
        n = n + (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))))
    return n


def _joined_length(words: Column) -> Column:
    return F.char_length(F.array_join(words, "")).cast("bigint")


def word_chars(text: Column) -> Column:
    return _joined_length(words_of(text))


def n_symbols(text: Column) -> Column:
    return _count(text, _SYMBOLS).cast("bigint")


def n_lines(text: Column) -> Column:
    return F.size(_lines(text)).cast("bigint")


def n_dup_lines(text: Column) -> Column:
    return _let(_lines(text), _repeated_lines)


def n_repeat_words(text: Column) -> Column:
    return _let(words_of(text), lambda w: _let(_window_hashes(w), _repeats))


def n_stutters(text: Column) -> Column:
    """Words equal to the word before."""
    return _let(words_of(text), _stutters)


def n_unspaced(text: Column) -> Column:
    """Code points of scripts that write no spaces between words."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, _UNSPACED, ""))).cast("bigint")


FEATURES: dict[str, Callable[[Column], Column]] = {f.__name__: f for f in (
    n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_stutters, n_unspaced)}


# --- rules ---------------------------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    """``rejects`` gets a function from a feature's name to its column."""
    name: str
    rejects: Callable[[Callable[[str], Column]], Column]


BASE = (
    Rule("few_words", lambda f: f("n_words") < 20),
    Rule("repeated_windows", lambda f: 100 * f("n_repeat_words") > 30 * f("n_words")),
)
RULES = BASE + (
    Rule("symbols", lambda f: 10 * f("n_symbols") > 3 * f("n_words")),
    Rule("duplicate_lines", lambda f: 10 * f("n_dup_lines") > 6 * f("n_lines")),
    Rule("stutter", lambda f: 4 * f("n_stutters") > f("n_words")),
    # words are long in no text half of whose characters are of scripts without spaces
    Rule("word_length", lambda f: (f("word_chars") < 2 * f("n_words")) | ((f("word_chars") > 12 * f("n_words")) &
                                                                        (2 * f("n_unspaced") <= f("word_chars")))),
)


def _of_text(text: Column) -> Callable[[str], Column]:
    return lambda name: FEATURES[name](text)


def measured(docs: DataFrame, rules=RULES, sample: int = SAMPLE) -> list[tuple[str, float, float]]:
    """(rule, seconds, share rejected) on a sample, by falling rejections per second.  The sample is
    the first rows read, and its size is bounded."""
    few = stored(few_texts(docs, sample, SAMPLE_CHARS), "quality-sample")      # else each plan holds the texts
    found = []
    for rule in rules:
        hit = F.avg(rule.rejects(_of_text(F.col("text"))).cast("double"))
        began = time.perf_counter()
        share = few.agg(hit.alias("x")).first()["x"] or 0.0
        found.append((rule.name, time.perf_counter() - began, share))
    return sorted(found, key=lambda x: -x[2] / max(x[1], 1e-9))


def in_order(docs: DataFrame, rules=RULES, sample: int = SAMPLE) -> list[Rule]:
    by_name = {r.name: r for r in rules}
    return [by_name[name] for name, _, _ in measured(docs, rules, sample)]


def keep_good(docs: DataFrame, rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that no rule rejects."""
    out = docs
    for rule in in_order(docs, rules, sample):
        out = out.filter(~rule.rejects(_of_text(text_of("text"))))
    return out


def quality_report(docs: DataFrame, rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, features, base_failed, kept, rejected_by) of each row: the rules in cascade
    order; ``rejected_by`` is the first that rejects.  Features that are asked for as columns are computed
    for all rows; the cascade computes n_lines, n_stutters and n_unspaced for rows that no earlier rule has rejected."""
    order = in_order(docs, rules, sample)
    wide = (docs.select("doc_id", text_of("text").alias("text"))
            .select("doc_id", "text", words_of(F.col("text")).alias("_w"), _lines(F.col("text")).alias("_l"))
            .select("doc_id", "text", "_w", "_l", _window_hashes(F.col("_w")).alias("_h")))
    lazy = {"n_lines": F.size("_l").cast("bigint"), "n_stutters": _stutters(F.col("_w")), "n_unspaced": n_unspaced(F.col("text"))}
    stats = wide.select(
        "doc_id", "text", "_w", "_l",
        F.size("_w").cast("bigint").alias("n_words"),
        _joined_length(F.col("_w")).alias("word_chars"),
        n_symbols(F.col("text")).alias("n_symbols"),
        _repeated_lines(F.col("_l")).alias("n_dup_lines"),
        _repeats(F.col("_h")).alias("n_repeat_words"))
    feature = lambda name: lazy[name] if name in lazy else F.col(name)
    by = F.lit(None).cast("string")
    for rule in reversed(order):
        by = F.when(rule.rejects(feature), F.lit(rule.name)).otherwise(by)
    judged = (stats.withColumn("base_failed", BASE[0].rejects(F.col) | BASE[1].rejects(F.col)).withColumn("rejected_by", by)
              .withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull()))
    return judged.withColumns(lazy).drop("text", "_w", "_l")
