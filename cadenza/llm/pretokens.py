"""Pre-tokens of byte-level BPE: the text split as the tokenizer's pattern splits it."""

from __future__ import annotations

import re

import regex

#: Added special token of the vocabulary; its string inside a text is one token.
SPECIAL = "<|endoftext|>"

# White_Space of Unicode, spelled out: \s of Python's engines holds other characters too.
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_FORM = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{W}{L}{N}]+|[{W}]+(?![^{W}])|[{W}]+"
_ANY = regex.compile(_FORM.format(L=r"\p{L}", N=r"\p{N}", W=_WS))
# Letters and numbers below U+0250, for the faster engine.
_LATIN = re.compile(_FORM.format(L="A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u024f",
                                 N="0-9\\xb2\\xb3\\xb9\\xbc-\\xbe", W=_WS))
_BEYOND = re.compile("[^\\x00-\\u024f]")


def plain_pieces(text: str) -> list[str]:
    """The pieces of a text without the special token."""
    return (_ANY if _BEYOND.search(text) else _LATIN).findall(text)


def pieces(text: str) -> list[str]:
    """The pieces of a text; joined, they are the text again."""
    if SPECIAL not in text:
        return plain_pieces(text)
    out: list[str] = []
    for k, part in enumerate(text.split(SPECIAL)):
        if k:
            out.append(SPECIAL)
        out.extend(plain_pieces(part))
    return out
