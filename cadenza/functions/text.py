"""String and key functions (Column -> Column), all native Spark expressions.

Python string semantics are reproduced where they differ from Java/Spark:
Unicode whitespace for strip/split, ``\\n``-only line ends, Unicode-aware
``\\b``/``\\d``/case folding.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C

# Characters Python's str.isspace() accepts (str.strip / str.split).
PY_WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
# The same set as a Java regex class body, used under (?U): (?U)\s is
# Unicode White_Space, which misses only 1C-1F.  (An explicit list of the
# code points is equivalent but several times slower in java.util.regex.)
WS_CLASS = r"\s\x{1c}-\x{1f}"
# Non-ASCII characters that Java's Unicode case-insensitive matching folds
# onto ASCII letters (long s, Kelvin sign, dotted/dotless i).
_ASCII_FOLDERS = ("\u017f", "\u212a", "\u0130", "\u0131")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def regex_escape(word: str) -> str:
    """Escape a literal for a Java regex (backslash before non-alphanumerics)."""
    return "".join(ch if ch.isalnum() or ch == "_" else "\\" + ch for ch in word)


def alternation(words: Iterable[str]) -> str:
    return "|".join(regex_escape(w) for w in words)


def strip(c) -> Column:
    """Python ``str.strip()``: removes Unicode whitespace at both ends."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def collapse_ws(c, repl: str = " ") -> Column:
    """``re.sub(r"\\s+", repl, s)`` with Python's Unicode whitespace."""
    return F.regexp_replace(_col(c), f"(?U)[{WS_CLASS}]+", repl)


def may_contain_ci(c, words) -> Column:
    """Cheap superset test for a case-insensitive regex over ``words``: the
    lower-cased text contains one of them, or a character that folds onto
    an ASCII letter is present.  Used to skip regexes that cannot match."""
    col = _col(c)
    low = F.lower(col)
    out = F.lit(False)
    for ch in _ASCII_FOLDERS:          # substring scans are far cheaper than a regex class
        out = out | col.contains(ch)
    for w in words:
        out = low.contains(w.lower()) | out
    return out


def is_blank(c) -> Column:
    """Non-null string that is empty after strip."""
    return strip(c) == F.lit("")


def is_missing(c) -> Column:
    """Missing rule: NULL, or a whitespace-only string (never NULL itself)."""
    col = _col(c)
    return col.isNull() | F.coalesce(is_blank(col.cast("string")), F.lit(False))


def not_missing(c) -> Column:
    return ~is_missing(c)


# --------------------------------------------------------------------------
# Keys
# --------------------------------------------------------------------------

ENRICH_KEY_TITLE_PATTERN = "(?iU)" + C.KEY_TITLE_DROP_PATTERN


def enrich_title(title) -> Column:
    t = F.regexp_replace(_col(title), ENRICH_KEY_TITLE_PATTERN, "")
    return strip(collapse_ws(t))


def enrich_key(title, artist) -> Column:
    """Enrichment key: title without parenthesised parts and version suffix,
    whitespace collapsed, lower-cased, joined with the artist.  NULL title or
    artist gives a NULL key (never matches)."""
    a = strip(collapse_ws(_col(artist)))
    return F.lower(F.concat(enrich_title(title), F.lit(C.KEY_SEP), a))


def lyrics_key(title, artist) -> Column:
    """Lyrics key: lower(strip(title)) ||| lower(strip(artist)), suffixes kept."""
    return F.concat(F.lower(strip(title)), F.lit(C.KEY_SEP), F.lower(strip(artist)))


def answer_key(title, artist) -> Column:
    """Answer key: strip(title) ||| strip(artist), case kept; NULL -> ''."""
    return F.concat(F.coalesce(strip(title), F.lit("")), F.lit(C.KEY_SEP),
                    F.coalesce(strip(artist), F.lit("")))


def merge_norm(c) -> Column:
    """Merge key part: lower(strip(c)); NULL stays NULL."""
    return F.lower(strip(c))


def search_text(title, artist) -> Column:
    """Search request text ``track:"t" artist:"a"`` (debug column)."""
    return F.concat(F.lit('track:"'), _col(title), F.lit('" artist:"'), _col(artist), F.lit('"'))


def search_words(title, artist) -> Column:
    """The plain search form ``title artist`` (debug column)."""
    return F.concat(_col(title), F.lit(" "), _col(artist))


def join_names(arr, field: str = "name", sep: str = ", ") -> Column:
    """``", ".join(x[field] for x in arr)``."""
    return F.array_join(F.transform(_col(arr), lambda x: x[field]), sep)


# --------------------------------------------------------------------------
# Repair and cleaning
# --------------------------------------------------------------------------

def has_mojibake(c, telltales: Iterable[str] = C.MOJIBAKE_TELLTALES) -> Column:
    return _col(c).rlike(alternation(telltales))


def fix_mojibake(c, telltales: Iterable[str] = C.MOJIBAKE_TELLTALES) -> Column:
    """Repair UTF-8 text that was decoded as Latin-1, only when a telltale is
    present: Latin-1 encode (dropping unmappable characters), UTF-8 decode
    (dropping invalid bytes).  ``c`` stands in the result three times: a second
    repair belongs in a projection of its own."""
    col = _col(c)
    latin = F.encode(F.regexp_replace(col, r"[^\x{00}-\x{FF}]", ""), "ISO-8859-1")
    repaired = F.replace(F.make_valid_utf8(latin.cast("string")), F.lit("\ufffd"), F.lit(""))
    return F.when(has_mojibake(col, telltales), repaired).otherwise(col)


def corrupt_latin1(c) -> Column:
    """Produce mojibake: UTF-8 bytes read back as Latin-1."""
    return F.decode(F.encode(_col(c), "UTF-8"), "ISO-8859-1")


def clean_lyrics_fetch(c, line_words: Iterable[str] = C.FETCH_LINE_WORDS) -> Column:
    """Cleaning applied to freshly fetched lyrics: delete whole lines that
    contain a marker word, replace ``[...]`` with a space, collapse
    whitespace, strip.  Non-string -> ''."""
    col = _col(c)
    words = tuple(line_words)
    s = F.when(may_contain_ci(col, words),
               F.regexp_replace(col, rf"(?imdu)^.*({alternation(words)}).*$", "")).otherwise(col)
    s = F.when(s.contains("["), F.regexp_replace(s, r"(?d)\[.*?\]", " ")).otherwise(s)
    s = strip(collapse_ws(s))
    return F.coalesce(s, F.lit(""))


def clean_lyrics_gate(c, contributors: str = C.GATE_CONTRIBUTORS_WORD,
                      read_more: str = C.GATE_READ_MORE,
                      page: str = C.GATE_PAGE_WORD) -> Column:
    """Cleaning applied at the gate: cut from ``N Contributors`` to the end,
    from ``Read More`` to the end, remove ``Page N [Page M ...]``, strip.
    NULL stays NULL."""
    col = _col(c)
    s = F.when(may_contain_ci(col, [contributors]),
               F.regexp_replace(col, rf"(?isU)\b\d+[{WS_CLASS}]+{regex_escape(contributors)}[\s\S]*", "")
               ).otherwise(col)
    s = F.when(may_contain_ci(s, [read_more]),
               F.regexp_replace(s, rf"(?isu){regex_escape(read_more)}[\s\S]*", "")).otherwise(s)
    p = regex_escape(page)
    s = F.when(may_contain_ci(s, [page + " "]),
               F.regexp_replace(s, rf"(?isU){p} \d+(?:[{WS_CLASS}]+{p} \d+)*", "")).otherwise(s)
    return strip(s)


# --------------------------------------------------------------------------
# Tokens, counts, classification
# --------------------------------------------------------------------------

TOKEN_PATTERN = C.TOKEN_PATTERN


def tokens(c) -> Column:
    """Lower-case ASCII word tokens ``[A-Za-z']+``; NULL -> []."""
    col = _col(c)
    return F.coalesce(F.regexp_extract_all(F.lower(col), F.lit(TOKEN_PATTERN), 0),
                      F.array().cast("array<string>"))


def word_count(c) -> Column:
    """``len(s.split())`` with Python whitespace; NULL -> NULL.  Counts the
    runs of non-whitespace instead of materialising the word array."""
    return F.regexp_count(_col(c), F.lit(f"(?U)[^{WS_CLASS}]+")).cast("bigint")


def lyric_status(c, cfg: C.LyricStatusConfig = C.LyricStatusConfig(), low=None) -> Column:
    """GOOD / SHORT / SUMMARY / MISSING / INSTRUMENTAL, decided in this order:
    missing, instrumental whole word, fewer than ``short_words`` words,
    summary phrase substring, otherwise good.

    ``low``: a column that already holds the stripped lower-cased text, so that
    it is computed once.  SHORT looks at the first ``short_words`` words only."""
    low = F.lower(strip(c)) if low is None else _col(low)
    # the regex runs on lower-cased text, so a plain substring test is an exact pre-filter
    maybe = F.lit(False)
    for w in cfg.instrumental_words:
        maybe = maybe | low.contains(w)
    instrumental = maybe & low.rlike(rf"(?U)\b({alternation(cfg.instrumental_words)})\b")
    summary = F.lit(False)
    for kw in cfg.summary_keywords:
        summary = summary | low.contains(kw)
    n = max(0, cfg.short_words - 1)
    long = low.rlike(rf"(?U)^(?:[^{WS_CLASS}]++[{WS_CLASS}]++){{{n}}}[^{WS_CLASS}]")
    return (F.when(low.isNull() | (low == ""), F.lit("MISSING"))
            .when(instrumental, F.lit("INSTRUMENTAL"))
            .when(~long, F.lit("SHORT"))
            .when(summary, F.lit("SUMMARY"))
            .otherwise(F.lit("GOOD")))


# --------------------------------------------------------------------------
# Rendering
# --------------------------------------------------------------------------

PROMPT_TEMPLATE = C.PROMPT_TEMPLATE


def fmt2_or_na(c) -> Column:
    """Two decimals, or NA for NULL (Java formats NULL as 'null')."""
    col = _col(c)
    return F.when(col.isNull(), F.lit(C.PROMPT_MISSING)).otherwise(F.format_string("%.2f", col))


def prompt_text(title, artist, bpm, mode, sval, lval, laro) -> Column:
    """Render the per-track prompt.  BPM is printed unrounded, the three
    affect values with two decimals, missing values as NA."""
    mode_c = strip(mode)
    return F.format_string(
        PROMPT_TEMPLATE,
        strip(title), strip(artist),
        F.coalesce(_col(bpm).cast("string"), F.lit(C.PROMPT_MISSING)),
        F.when(mode_c != "", mode_c).otherwise(F.lit(C.PROMPT_MISSING)),
        fmt2_or_na(sval), fmt2_or_na(lval), fmt2_or_na(laro))

