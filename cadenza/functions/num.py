"""Numeric, mode and scoring functions (Column -> Column).

The arithmetic is written in the same order as the original per-row code so
that doubles come out bit-identical (sums left to right, weights normalised
before missing features are dropped).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from .text import _col, strip

# Plain decimal/scientific number after strip; excludes nan/inf, Java float
# suffixes (1.5d) and digit separators (1_0), which try_cast would accept or
# which the original coercion rejects.
NUMERIC_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def coerce_number(c) -> Column:
    """Text or number -> DOUBLE; anything unparsable -> NULL (never raises)."""
    s = strip(_col(c).cast("string"))
    return F.when(s.rlike(NUMERIC_PATTERN), s.try_cast("double"))


def sanitize(c) -> Column:
    """NaN, +Inf, -Inf -> NULL (doubles are never stored as NaN)."""
    col = _col(c).cast("double")
    bad = F.isnan(col) | (col == F.lit(float("inf"))) | (col == F.lit(float("-inf")))
    return F.when(~bad, col)


def nan_to_null(c) -> Column:
    col = _col(c)
    return F.nanvl(col, F.lit(None).cast("double"))


def positive_or_null(c) -> Column:
    """Provider tempo of 0 (or below) means unknown."""
    col = _col(c)
    return F.when(col > 0, col)


def zero_to_null(c) -> Column:
    col = _col(c)
    return F.when(col != 0, col)


def rescale_polarity(c) -> Column:
    """-1..1 polarity -> 0..1."""
    return (_col(c) + F.lit(1.0)) / F.lit(2.0)


def sentiment_fallback(lex, p1, p2) -> Column:
    """Lexicon valence, else scorer 1 unless it is 0 or missing, else scorer 2."""
    return F.coalesce(_col(lex), zero_to_null(p1), _col(p2))


def mode_from_int(c) -> Column:
    """1 -> Major, 0 -> Minor, anything else -> NULL."""
    col = _col(c)
    return F.when(col == 1, F.lit("Major")).when(col == 0, F.lit("Minor"))


def mode_from_key_string(c) -> Column:
    """Key text such as 'C major', 'A Minor', 'G#m': 'major' anywhere ->
    Major; 'minor' anywhere or a trailing 'm' -> Minor; else NULL.  Bare
    note names ('C', 'C#') give NULL; no strip ('Am ' -> NULL)."""
    s = F.lower(_col(c))
    return (F.when(_col(c).isNull() | (_col(c) == ""), F.lit(None).cast("string"))
            .when(s.contains("major"), F.lit("Major"))
            .when(s.contains("minor") | s.endswith("m"), F.lit("Minor")))


def mode_from_scale_text(c) -> Column:
    """Scale text: 'major'/'minor' after lower+strip; else NULL."""
    s = F.lower(strip(c))
    return F.when(s == "major", F.lit("Major")).when(s == "minor", F.lit("Minor"))


def mode_from_scale_number(c) -> Column:
    """Numeric scale truncated toward zero: 1 -> Major, 0 -> Minor."""
    t = _col(c).cast("double").try_cast("bigint")
    return F.when(t == 1, F.lit("Major")).when(t == 0, F.lit("Minor"))


# --------------------------------------------------------------------------
# Scoring
# --------------------------------------------------------------------------

def range_decay(c, ideal_min, ideal_max, hard_min, hard_max) -> Column:
    """A trapezoid: 1 on the ideal range, straight lines down to 0 at the hard
    limits, clipped to 0..1; NULL in -> NULL."""
    x = _col(c)
    rise = (x - F.lit(float(hard_min))) / F.lit(float(ideal_min - hard_min))
    fall = F.lit(1.0) - (x - F.lit(float(ideal_max))) / F.lit(float(hard_max - ideal_max))
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), rise, fall)))


def bpm_score(c) -> Column:
    """Best of the two tempo bands; NULL in -> NULL."""
    return F.greatest(*[range_decay(c, *r) for r in C.BPM_RANGES])


def valence_score(c) -> Column:
    return range_decay(c, *C.VALENCE_RANGE)


def arousal_score(c) -> Column:
    return range_decay(c, *C.AROUSAL_RANGE)


def _literal_map(d: dict) -> Column:
    kv = []
    for k, v in d.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def mode_score(c, scores: dict = C.MODE_SCORES, other: float = C.MODE_SCORE_OTHER) -> Column:
    """Mode name -> score; unknown (incl. blank) -> ``other``; NULL -> NULL."""
    col = _col(c)
    key = F.lower(strip(col.cast("string")))
    return F.when(col.isNotNull(),
                  F.coalesce(F.try_element_at(_literal_map(scores), key), F.lit(other)))


def evidence_multiplier(c, multipliers: dict = C.EVIDENCE_MULTIPLIERS,
                        default: float = C.EVIDENCE_DEFAULT_MULTIPLIER) -> Column:
    """Evidence label -> multiplier; NULL or unknown -> ``default``."""
    key = strip(F.lower(_col(c).cast("string")))
    return F.coalesce(F.try_element_at(_literal_map(multipliers), key), F.lit(default))


def fill_evidence(c, default: str) -> Column:
    """Missing or blank evidence label -> the feature's default label."""
    col = _col(c).cast("string")
    return F.when(col.isNull() | (strip(col) == ""), F.lit(default)).otherwise(col)


def letter_grade(c, cutoffs: dict = C.LETTER_CUTOFFS) -> Column:
    """The first grade of ``cutoffs`` (given from the highest cutoff down) that
    the percentage reaches; NULL -> N/A; below every cutoff -> F."""
    col = _col(c)
    out = F.when(col.isNull(), F.lit(C.GRADE_MISSING))
    for grade, cut in cutoffs.items():
        out = out.when(F.lit(100) * col >= cut, F.lit(grade))
    return out.otherwise(F.lit(C.GRADE_BELOW_ALL))


def weighted_total(scores: list, weights: list) -> Column:
    """Sum of score*weight over present scores divided by the sum of their
    weights (left to right); no present score -> NULL."""
    numer = None
    denom = None
    for s, w in zip(scores, weights):
        term = F.coalesce(s * w, F.lit(0.0))
        wt = F.when(s.isNotNull(), w).otherwise(F.lit(0.0))
        numer = term if numer is None else numer + term
        denom = wt if denom is None else denom + wt
    return F.when(denom != 0, numer / denom)
