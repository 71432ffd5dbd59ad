"""Packing: documents into sequences of ``CAPACITY`` tokens of balanced attention cost.

The rows of a task are taken in runs of about ``RUN`` tokens.  A run of T tokens gets
T // capacity full sequences and, for the rest, one sequence for each power of two in it, so
nothing is padded.  What a document has beyond whole sequences' worth of tokens is cut off its
front: those pieces fill a sequence each.  The remainders are dealt in descending order, each to
the sequence of least cost that has room for it, where a piece of n tokens costs
``LINEAR`` * n + n * n (feed-forward work grows with n, attention with its square).  The ones
that no sequence has room for are cut over what is left, the least costly sequences first.

A run never leaves its task, so nothing is shuffled, no group can be large, and a task holds the
ids of one run and one document.  A sequence is named by its task's partition and its number there; a
task that runs again makes the same sequences of the same rows, as a scan of files gives them
(write rows that come out of a shuffle first).

Texts are encoded between ASCII white space, which the tokenizer drops and no token crosses, so what a
worker remembers of frequent strings gives the ids of the whole text.  NULL and empty texts have
the end token alone; repeated rows are packed one by one; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .base import text_of

CAPACITY = 2048
END = 1                # id behind each document
LINEAR = 4096          # cost of a token next to that of a pair of tokens
RUN = 1 << 22          # tokens of a run
DOCS = 1 << 16         # and its documents at most
KNOWN = 600_000        # strings that a worker remembers, and as many from before ...
LONGEST = 64           # ... of at most so many characters
BATCH = 8 << 20        # bytes of texts that are encoded at a time
PART = 1 << 13         # characters of strings that are encoded at a time
MARK = "<|startoftext|>"

#: A word of Latin letters, which is one piece of the tokenizer, and what no piece shares with it.
_LETTERS = "A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff"
_WORD = re.compile(f"([{_LETTERS}]+)([!-&(-/:-@\\[-`{{-~]*)\\Z")


class Strings:
    """String without ASCII white space -> its ids as little-endian bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        # plain dicts of strings and bytes, which the garbage collector passes over
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.last = np.zeros(max(vocab.values()) + 1, bool)          # ids that end a piece
        for t, i in vocab.items():
            self.last[i] = t.endswith("</w>") or t == MARK

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, units: list[str], words: bool, keep: dict) -> None:
        """Adds the ids of units, which are encoded as one text: words stand between spaces and are a piece each,
        others between special tokens."""
        ids = self._ids((" " if words else MARK).join(units))
        if words:
            ends = (np.flatnonzero(self.last[ids]) + 1).tolist()
        else:
            ends = np.append(np.flatnonzero(ids == self.tokenizer.token_to_id(MARK)), len(ids)).tolist()
        if len(ends) != len(units):
            raise ValueError("the vocabulary's tokens don't show where words end")
        data, at = ids.tobytes(), 0
        for u, e in zip(units, ends):
            keep[u] = data[4 * at:4 * e]
            at = e if words else e + 1

    def _learn_all(self, units, words: bool, keep: dict) -> None:
        held, size = [], 0
        for u in units:
            held.append(u)
            size += len(u) + 1
            if size >= PART:
                self._learn(held, words, keep)
                held, size = [], 0
        if held:
            self._learn(held, words, keep)

    def _learn_new(self, new: list[str]) -> dict:
        keep, match = {"": b""}, _WORD.match
        split = {u: (m[1].lower(), m[2]) for u in new if (m := match(u))}
        others = set(new).difference(split)
        others.update(tail for _, tail in split.values() if tail)
        others.discard("")
        for u in [u for u in others if MARK in u]:
            keep[u] = self._ids(u).tobytes()
        self._learn_all(sorted(u for u in others if u not in self.known and u not in keep), False, keep)
        self._learn_all(sorted({w for w, _ in split.values() if w not in self.known}), True, keep)
        known = lambda u: keep[u] if u in keep else self.known[u]
        for u, (word, tail) in split.items():
            if u not in keep:
                keep[u] = known(word) + known(tail) if tail else known(word)
        return keep

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text: the different strings of all of them are looked up once, and their ids gathered."""
        if len(self.known) > KNOWN:
            self.older, self.known = self.known, {}
        cut = pc.ascii_split_whitespace(texts)
        coded = cut.flatten().dictionary_encode()
        units = coded.dictionary.to_pylist()
        found = list(map(self.known.get, units))
        holes = []
        for k, x in enumerate(found):
            if x is None:
                u = units[k]
                x = self.older.get(u)
                if x is None:
                    holes.append(k)
                else:
                    found[k] = self.known[u] = x
        if holes:
            keep = self._learn_new([units[k] for k in holes])
            for k in holes:
                found[k] = keep[units[k]]
            self.known.update((u, x) for u, x in keep.items() if len(u) <= LONGEST)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        places = np.cumsum(sizes) - sizes
        which = coded.indices.to_numpy()
        n = sizes[which]
        ends = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(places[which] - ends[:-1], n)
        at += np.arange(ends[-1])
        ids = np.frombuffer(b"".join(found), "<u4")[at]
        stops = ends[cut.offsets.to_numpy()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(stops, stops[1:])]


def deal(lengths: list[int], capacity: int = CAPACITY, linear: int = LINEAR) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of pieces that hold each token of documents of
    these lengths once.  All sequences are full: those of ``capacity`` tokens come first, then at
    most one for each smaller power of two."""
    total = sum(lengths)
    sizes = [capacity] * (total // capacity)
    sizes += [1 << k for k in range(capacity.bit_length() - 1, -1, -1) if total % capacity >> k & 1]
    room = np.array(sizes, np.int64)
    cost = np.zeros(len(sizes))
    size = np.array(sizes, np.int64)
    out = []

    def put(doc: int, start: int, n: int, k: int) -> None:
        out.append((doc, start, n, k, int(size[k] - room[k])))
        room[k] -= n
        cost[k] = np.inf if room[k] == 0 else cost[k] + linear * n + n * n

    whole, rests = 0, []
    for doc, n in enumerate(lengths):
        for start in range(0, n - capacity + 1, capacity):
            put(doc, start, capacity, whole)
            whole += 1
        if n % capacity:
            rests.append((n % capacity, doc, n - n % capacity))
    rests.sort(key=lambda r: (-r[0], r[1]))
    late = []
    for n, doc, start in rests:
        free = np.where(room >= n, cost, np.inf)
        k = int(free.argmin()) if len(free) else 0
        if np.isfinite(free[k]):
            put(doc, start, n, k)
        else:
            late.append((n, doc, start))
    for n, doc, start in late:
        while n:
            k = int(cost.argmin())
            part = min(n, int(room[k]))
            put(doc, start, part, k)
            n, start = n - part, start + part
    return out


_STRINGS: dict[str, Strings] = {}


def _larger(batches, size: int = BATCH):
    """Batches joined to tables of about ``size`` bytes, so that fewer strings are looked up."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.nbytes
        if n >= size:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, run: int = RUN) -> DataFrame:
    """(doc_id, doc_tokens, start, sequence_id, offset, ids) of each piece; ``ids`` are little-endian
    unsigned 32-bit integers in a binary.

    ``docs`` has doc_id and text; ``tokenizer`` is the path of a file of the tokenizers library whose
    tokens never cross white space (default: word_bpe_49k.json, looked up where the task runs);
    ``capacity`` is a power of two.
    """
    kind = docs.schema["doc_id"].dataType
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")

    def packed(ids: list, texts: list, name: int) -> tuple[int, pa.RecordBatch]:
        lengths = [len(x) // 4 for x in texts]
        rows = deal(lengths, capacity)
        doc, start, n, seq, offset = map(list, zip(*rows)) if rows else ([], [], [], [], [])
        batch = pa.RecordBatch.from_arrays(
            [pa.array([ids[d] for d in doc], ids_type), pa.array([lengths[d] for d in doc], pa.int64()),
             pa.array(start, pa.int64()), pa.array([name + s for s in seq], pa.int64()), pa.array(offset, pa.int64()),
             pa.array([texts[d][4 * a:4 * (a + m)] for d, a, m in zip(doc, start, n)], pa.binary())],
            names=["doc_id", "doc_tokens", "start", "sequence_id", "offset", "ids"])
        return name + (max(seq) + 1 if seq else 0), batch

    from pyspark.sql.pandas.types import to_arrow_type
    ids_type = to_arrow_type(kind)

    def run_task(batches):
        import os
        from pyspark import TaskContext
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = tokenizer
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path("word_bpe_49k.json")
        known = _STRINGS.get(path) or _STRINGS.setdefault(path, Strings(path))
        end = np.array([END], "<u4").tobytes()
        name, held = TaskContext.get().partitionId() << 40, 0
        ids, texts = [], []
        for b in _larger(batches):
            for i, encoded in zip(b.column(0).to_pylist(), known.encode(b.column(1).combine_chunks())):
                ids.append(i)
                texts.append(encoded + end)
                held += len(texts[-1]) // 4
                if held >= run or len(ids) >= DOCS:
                    name, batch = packed(ids, texts, name)
                    yield batch
                    ids, texts, held = [], [], 0
        if ids:
            yield packed(ids, texts, name)[1]

    return docs.select("doc_id", text_of("text").alias("text")).mapInArrow(
        run_task, f"doc_id {kind.simpleString()}, doc_tokens bigint, start bigint, sequence_id bigint, offset bigint, ids binary")
