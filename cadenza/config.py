"""Configuration: the fixed values the results depend on, plus tunables.

Everything in the FIXED VALUES block must equal the values of the pipeline
this engine re-implements, otherwise scores, grades, labels and statuses
change.  They are stated once, here, in their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original pipeline for identical results)
# ---------------------------------------------------------------------------

# Base feature weights of the evidence-weighted score.
BASE_WEIGHTS = {
    "bpm": 0.25,
    "mode": 0.20,
    "lyric_valence": 0.25,
    "lyric_arousal": 0.30,
}

# Evidence label -> weight multiplier (label compared lower-cased, stripped).
EVIDENCE_MULTIPLIERS = {
    "rct": 1.15,
    "meta": 1.10,
    "systematic": 1.10,
    "observational": 0.95,
    "clinical": 0.95,
    "theoretical": 0.85,
    "mechanistic": 0.85,
    "anecdotal": 0.75,
    "indirect": 0.75,
}
EVIDENCE_DEFAULT_MULTIPLIER = 1.0

# Default evidence label per feature when the label is missing or blank.
DEFAULT_EVIDENCE = {
    "bpm": "meta",
    "mode": "theoretical",
    "lyric_valence": "observational",
    "lyric_arousal": "observational",
}

# Letter grade -> minimum percentage (100 * score), checked high to low.
LETTER_CUTOFFS = {
    "A+": 97, "A": 93, "A-": 90,
    "B+": 87, "B": 83, "B-": 80,
    "C+": 77, "C": 73, "C-": 70,
    "D": 60, "F": 0,
}
GRADE_BELOW_ALL = "F"
GRADE_MISSING = "N/A"

# Mode name -> score; anything else non-null scores MODE_SCORE_OTHER.
MODE_SCORES = {"major": 1.0, "mixolydian": 0.8, "dorian": 0.5, "minor": 0.4}
MODE_SCORE_OTHER = 0.3

# Range-decay parameters: (ideal_min, ideal_max, hard_min, hard_max).
BPM_RANGES = ((60, 80, 50, 130), (100, 120, 50, 130))
VALENCE_RANGE = (0.2, 0.6, -0.5, 1.0)
AROUSAL_RANGE = (0.2, 0.6, -0.3, 1.0)

# Lyric status classifier.
SHORT_WORDS = 25
INSTRUMENTAL_WORDS = ("instrumental", "no lyrics", "piano", "sonata", "etude",
                      "nocturne", "symphony")
SUMMARY_KEYWORDS = (
    "originally written", "composed", "published", "recorded",
    "song has", "as the song", "this song", "track features",
    "performed by", "is about", "theme of", "lyrics talk about",
    "music was", "believed to be", "released in", "instrumental",
)
FLAGGED_STATUSES = ("SHORT", "SUMMARY", "MISSING", "INSTRUMENTAL")

# Mojibake telltales (UTF-8 read as Latin-1).
MOJIBAKE_TELLTALES = ("Ã", "Â", "â€™", "â€œ", "â€\x9d", "â€“", "â€”")

# Lyrics cleaning at fetch time: whole lines containing one of these words
# (case-insensitive) are deleted.
FETCH_LINE_WORDS = ("embed", "you might also like", "contributors")

# Lyrics cleaning at the gate: trailing junk markers.
GATE_CONTRIBUTORS_WORD = "Contributors"
GATE_READ_MORE = "Read More"
GATE_PAGE_WORD = "Page"

# Enrichment key: parts of the title that are dropped (applied case-insensitively).
KEY_TITLE_DROP_PATTERN = r"\s*\(.*?\)|\s*-\s*(Remaster(ed)?|Live|Acoustic|Radio Edit|Mono|Stereo).*?$"

# Key separator of every song key.
KEY_SEP = "|||"

# Readiness gate: required columns, in the order the missing list names them.
REQUIRED_COLUMNS = ("track_id", "source_link", "bpm", "mode", "lyric_valence")
REQUIRED_LABELS = {
    "track_id": "Track ID",
    "source_link": "Source Link",
    "bpm": "BPM",
    "mode": "Mode",
    "lyric_valence": "Lyric sentiment valence",
}
READY_LABEL, HOLD_LABEL = "READY", "HOLD"
DEFAULT_CURATOR = "You"
PROVENANCE_DEFAULT = "spotify/analysis"

# Minimum size of an audio clip in bytes (smaller clips are rejected).
MIN_CLIP_BYTES = 5000

# Provider labels of the BPM/Mode fallback chain, in priority order.
CACHE_LABEL = "cache"
# A clip analysis that names its analyser ("producer") is labelled with it: the
# analysers of a preview clip may differ from the default one.
PROVIDER_LABELS = {
    "p1_bpm": "Deezer(bpm)",
    "p2_preview": "librosa(deezer)",
    "p3_search": "GetSongBPM",
    "p4_preview": "librosa(itunes)",
}

# Lyric tokens: runs of ASCII letters and apostrophes (of the lower-cased text).
TOKEN_PATTERN = "[A-Za-z']+"

# Listening-context prompt: system message and the per-track text with its
# attributes, task and constraints; "NA" marks a missing value.
PROMPT_SYSTEM = (
    "You are assisting a music-therapy research workflow for non-clinical use. "
    "Your job: Given a song's metadata and lyric affect (valence/arousal), "
    "propose a conservative listening context and clear contraindications. "
    "Do not give medical advice. Do not diagnose. Avoid prescriptive claims. "
    "Prefer low-risk, opt-in contexts (e.g., solo listening with breathing guidance). "
    "If risk cues exist (e.g., violent/explicit/self-harm themes), flag them as contraindications. "
    "Return strictly valid JSON with keys: "
    "listening_context (string), contraindications (string), rationale (string <= 140 chars)."
)
PROMPT_TEMPLATE = (
    "Song: %s — %s\n"
    "Attributes:\n"
    "- BPM: %s\n"
    "- Mode: %s\n"
    "- Spotify valence: %s\n"
    "- Lyric valence: %s\n"
    "- Lyric arousal: %s\n\n"
    "Task:\n"
    "1) Suggest one concise listening_context string suitable for a cautious, non-clinical setting for "
    "depression-focused research (e.g., 'eyes-closed, paced breathing, dim light, 10 min').\n"
    "2) List contraindications as a concise string (e.g., 'avoid during acute panic; explicit content may "
    "trigger rumination').\n"
    "3) Provide a short rationale (<=140 chars).\n\n"
    "Constraints:\n"
    "- No medical advice. No guarantees of efficacy. Conservative tone.\n"
    "- Prefer downshifting arousal if lval<0 or laro>0.7.\n"
    "- Output strict JSON only."
)
PROMPT_MISSING = "NA"

# Pitch classes compared by the chroma mode rule: major {0,4,7}, minor {0,3,7}.
CHROMA_MAJOR = (0, 4, 7)
CHROMA_MINOR = (0, 3, 7)

# ---------------------------------------------------------------------------
# Tunables (not semantics)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Tuning:
    # Rows per chunk when a per-key scan is split across tasks.
    scan_chunk_rows: int = 1 << 16


@dataclass(frozen=True)
class ScoreConfig:
    base_weights: dict = field(default_factory=lambda: dict(BASE_WEIGHTS))
    multipliers: dict = field(default_factory=lambda: dict(EVIDENCE_MULTIPLIERS))
    default_evidence: dict = field(default_factory=lambda: dict(DEFAULT_EVIDENCE))
    cutoffs: dict = field(default_factory=lambda: dict(LETTER_CUTOFFS))


@dataclass(frozen=True)
class LyricStatusConfig:
    short_words: int = SHORT_WORDS
    instrumental_words: tuple = INSTRUMENTAL_WORDS
    summary_keywords: tuple = SUMMARY_KEYWORDS


TUNING = Tuning()
