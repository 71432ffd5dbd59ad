"""Token counts by overlap resynchronisation.

A huge document is encoded in chunks that overlap.  The left chunk starts at a
proven boundary, so each of its pieces is right except near its end, where the
cut can change a piece.  The right chunk starts anywhere, so its first pieces
can be wrong.  A boundary that both chunks have, far enough from the left
chunk's end, is stable: the pattern of the tokenizer never looks behind a
boundary, so from there on the right chunk's pieces are those of the whole
text.  The chunks are spliced there.  Without such a boundary the overlap is
widened and the step repeated, in the end to the whole rest of the text.

The token number of a piece comes from the tokenizer library and is kept per
worker, as pieces recur.  Nulls and empty texts have 0 bytes and 0 tokens;
repeated rows are counted row by row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from .base import rows_of, text_of
from .pretokens import SPECIAL, pieces

CHUNK = 1 << 16        # characters of a chunk
OVERLAP = 256          # characters that neighbouring chunks share at first
KNOWN = 400_000        # pieces that a worker remembers ...
LONGEST = 256          # ... of at most so many characters


def spliced(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[list[str]]:
    """The pieces of ``text`` as consecutive lists, at most about ``chunk`` characters each."""
    n = len(text)
    start, end = 0, min(chunk, n)
    left = pieces(text[:end])
    while end < n:
        room, reach = overlap, chunk
        while True:
            at = max(start, end - room)
            stop = min(n, at + max(reach, 2 * room))
            right = pieces(text[at:stop])
            cut = _common(left, start, end, right, at)
            if cut:
                break
            if at == start:          # the chunks share all there is: take a longer left chunk
                end = min(n, end + room)
                left = pieces(text[start:end])
                if end == n:
                    break
            room *= 2
        if not cut:
            break
        i, j, start = cut
        yield left[:i]
        left, end = right[j:], stop
    yield left


def _common(left: list[str], start: int, end: int, right: list[str], at: int):
    """The last boundary that both have and that the cut at ``end`` can't move: (pieces of
    the left chunk before it, pieces of the right chunk before it, its offset)."""
    ends = list(accumulate(map(len, left), initial=start))
    limit = end - len(SPECIAL)
    right_ends = {o: j for j, o in enumerate(accumulate(map(len, right), initial=at))}
    for i in range(len(ends) - 4, 0, -1):
        o = ends[i]
        if o < at:
            return None
        if o <= limit and right_ends.get(o, 0) > 0:
            return i, right_ends[o], o
    return None


class PieceCounts(dict):
    """Piece -> number of tokens, from the tokenizer library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def count(self, found: list[str]) -> int:
        try:
            return sum(map(self.__getitem__, found))
        except KeyError:
            if len(self) > KNOWN:
                self.clear()
            new, long = [p for p in set(found) if p not in self], {}
            for p, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
                (self if len(p) <= LONGEST else long)[p] = len(e.ids)
            return sum(self[p] if p in self else long[p] for p in found)


_COUNTS: dict[str, PieceCounts] = {}


def token_counts(docs: DataFrame, tokenizer: str | None = None, chunk: int = CHUNK,
                 overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of each row of ``docs`` (doc_id, text).

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers library
    (default: byte_bpe_50k.json, looked up where the task runs).
    """
    import os

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if tokenizer is None:
            import public_tokenizers
            path = public_tokenizers.path("byte_bpe_50k.json")
        else:
            path = tokenizer
        known = _COUNTS.get(path) or _COUNTS.setdefault(path, PieceCounts(path))
        for b in batches:
            rows = rows_of(b)
            sizes, counts = [], []
            for t in rows["text"]:
                sizes.append(len(t.encode("utf-8")))
                counts.append(sum(known.count(found) for found in spliced(t, chunk, overlap)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_of("text").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
