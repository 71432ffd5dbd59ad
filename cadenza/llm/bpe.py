"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

The pre-tokens of all documents are counted (by the strings between spaces, so that
only distinct strings are cut into pre-tokens); the most frequent ones, at most
``LEXICON``, are merged once and compiled into a minimal acyclic
automaton (common prefixes and suffixes share states).  Each arc carries the
number of lexicon words passed over by taking it, so a walk ends in the word's
number and with it in its ids.  The flat tables are broadcast (their size is
bounded by ``LEXICON``), written once per worker and memory-mapped.  Words that
the automaton lacks are merged exactly.  The lexicon only saves work: ids never
depend on it.

Nulls and empty texts give no ids and an empty text; repeated rows are handled
row by row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import struct
import tempfile
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import stored, text_of
from .pretokens import SPECIAL
from .token_counts import spliced

LEXICON = 50_000      # words of the automaton at most
LONGEST = 64           # bytes of a lexicon word at most
KNOWN = 1_000_000      # words that a worker remembers

_BITS, _MASK, _NONE = 20, (1 << 20) - 1, 1 << 60      # a merge as one number: its rank, then the new id


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable bytes stand for
    themselves, the others for letters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in shown}
    for k, b in enumerate(b for b in range(256) if b not in set(shown)):
        out[chr(0x100 + k)] = b
    return out


class Merger:
    """Exact merges of one word, and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.bytes_of = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        self.special = {}
        for a in spec["added_tokens"]:
            self.special[a["content"].encode("utf-8")] = a["id"]
            self.bytes_of[a["id"]] = a["content"].encode("utf-8")
        self.id_of_byte = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.merges = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merges[vocab[a] << _BITS | vocab[b]] = rank << _BITS | vocab[a + b]

    def __call__(self, word: bytes) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        ids = [self.id_of_byte[b] for b in word]
        return self._short(ids) if len(ids) <= 48 else self._long(ids)

    def _short(self, ids: list[int]) -> list[int]:
        get = self.merges.get
        ranks = [get(a << _BITS | b, _NONE) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == _NONE:
                break
            k = ranks.index(best)
            ids[k] = best & _MASK
            del ids[k + 1], ranks[k]
            if k:
                ranks[k - 1] = get(ids[k - 1] << _BITS | ids[k], _NONE)
            if k < len(ranks):
                ranks[k] = get(ids[k] << _BITS | ids[k + 1], _NONE)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        """The same by a heap over a linked list, for long words."""
        n, get = len(ids), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k, a, b) for k, (a, b) in enumerate(zip(ids, ids[1:]))
                if (r := get(a << _BITS | b, _NONE)) != _NONE]
        heapq.heapify(heap)
        while heap:
            r, k, a, b = heapq.heappop(heap)
            j = after[k] if ids[k] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[k], ids[j] = r & _MASK, -1
            after[k] = after[j]
            if after[j] < n:
                before[after[j]] = k
            for x, y in ((before[k], k), (k, after[k])):
                if x >= 0 and y < n and (r := get(ids[x] << _BITS | ids[y], _NONE)) != _NONE:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]


# --- the automaton -------------------------------------------------------------------------

def compile_lexicon(words: list[bytes], merge: Merger) -> bytes:
    """Flat tables of the minimal acyclic automaton of ``words`` with their ids.

    Layout (little-endian u32 unless said): numbers of states, arcs, words and ids; first
    arc of each state and one more; target of each arc; words passed over by each arc;
    first id of each word and one more; ids; final flag (u8) of each state; label (u8) of
    each arc.
    """
    words = sorted(set(words))
    register: dict = {}
    states: list[tuple] = []                   # (final, ((label, state), ...)), minimal

    def settle(node) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    path = [[False, []]]                       # the states of the last word, not yet settled
    labels: list[int] = []

    def close(depth: int) -> None:
        while len(path) - 1 > depth:
            done = settle(path.pop())
            path[-1][1].append((labels.pop(), done))

    last = b""
    for w in words:
        common = 0
        while common < min(len(w), len(last)) and w[common] == last[common]:
            common += 1
        close(common)
        for b in w[common:]:
            labels.append(b)
            path.append([False, []])
        path[-1][0] = True
        last = w
    close(0)
    root = settle(path[0])
    below = []                                 # words from each state; targets come first
    for final, arcs in states:
        below.append(final + sum(below[t] for _, t in arcs))
    order = [root] + [s for s in range(len(states)) if s != root]
    number = {s: k for k, s in enumerate(order)}
    first, target, passed, label, final_flags = [0], [], [], bytearray(), bytearray()
    for s in order:
        final, arcs = states[s]
        over = int(final)
        for b, t in arcs:
            label.append(b)
            target.append(number[t])
            passed.append(over)
            over += below[t]
        final_flags.append(final)
        first.append(len(target))
    starts, ids = [0], []
    for w in words:
        ids += merge(w)
        starts.append(len(ids))
    ints = [len(order), len(target), len(words), len(ids), *first, *target, *passed, *starts, *ids]
    return struct.pack(f"<{len(ints)}I", *ints) + bytes(final_flags) + bytes(label)


class Lexicon:
    """Look-ups in the tables of ``compile_lexicon``, memory-mapped."""

    def __init__(self, tables: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(tables)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        view = memoryview(self.map)
        n, a, w, i = struct.unpack_from("<4I", self.map)
        at = 16

        def ints(k):
            nonlocal at
            at += 4 * k
            return view[at - 4 * k:at].cast("I")

        self.first, self.target, self.passed = ints(n + 1), ints(a), ints(a)
        self.starts, self.ids = ints(w + 1), ints(i)
        self.final = view[at:at + n]
        self.label = bytes(view[at + n:at + n + a])

    def number(self, word: bytes) -> int:
        """The word's number, or -1."""
        s = over = 0
        first, find = self.first, self.label.find
        for b in word:
            k = find(b, first[s], first[s + 1])
            if k < 0:
                return -1
            over += self.passed[k]
            s = self.target[k]
        return over if self.final[s] else -1

    def get(self, word: bytes):
        """The ids as little-endian bytes, or None."""
        k = self.number(word)
        return None if k < 0 else bytes(self.ids[self.starts[k]:self.starts[k + 1]])


class Encoder(dict):
    """Piece -> ids as little-endian bytes: the automaton first, else exact merges."""

    def __init__(self, path: str, tables: bytes):
        super().__init__()
        self.merge, self.lexicon = Merger(path), Lexicon(tables)
        by_id = [self.merge.bytes_of.get(i, b"") for i in range(max(self.merge.bytes_of) + 1)]
        self.sizes = np.array([len(b) for b in by_id])
        self.places = np.cumsum(self.sizes) - self.sizes
        self.joined = np.frombuffer(b"".join(by_id), np.uint8)

    def __missing__(self, piece: str) -> bytes:
        word = piece.encode("utf-8")
        ids = self.lexicon.get(word) if len(word) <= LONGEST else None
        if ids is None:
            found = self.merge(word)
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(word) <= 4 * LONGEST:
            if len(self) > KNOWN:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(b"".join(map(self.__getitem__, found)) for found in spliced(text))

    def decode(self, ids: bytes) -> str:
        """The ids' bytes side by side, as text."""
        ids = np.frombuffer(ids, "<u4")
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ends):
            return ""
        at = np.repeat(self.places[ids] - ends + sizes, sizes)
        at += np.arange(ends[-1])
        return self.joined[at].tobytes().decode("utf-8", "replace")


# --- the operator --------------------------------------------------------------------------

def vocabulary_path(path: str | None) -> str:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    return path


def frequent_words(docs: DataFrame, n: int = LEXICON) -> list[bytes]:
    """The most frequent pre-tokens of all texts of ``docs``: whole levels of frequency (eight
    for each doubling), as many as have at most ``n`` words."""

    # strings between spaces are counted first; only the distinct ones are cut into pre-tokens
    strings = (docs.select(F.explode(F.split(text_of("text"), " ", -1)).alias("s"))
               .groupBy("s").agg(F.count(F.lit(1)).alias("n")))

    def cut(batches):
        for b in batches:
            seen: Counter = Counter()
            for string, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for part in spliced(" " + string):
                    for w in part:
                        seen[w] += k
            short = [(w, k) for w, k in seen.items() if len(w) <= LONGEST and w != SPECIAL]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in short], pa.string()), pa.array([k for _, k in short], pa.int64())],
                names=["word", "n"])

    counts = strings.mapInArrow(cut, "word string, n bigint")
    counts = stored(counts.groupBy("word").agg(F.sum("n").alias("n"), F.floor(8 * F.log2(F.sum("n"))).alias("level")),
                    "bpe-words")
    # the least level of frequency from which on at most n words remain: a few hundred levels
    left, least = n, None
    for r in counts.groupBy("level").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("level")).collect():
        left -= r["k"]
        if left < 0:
            break
        least = r["level"]
    if least is None:
        return []
    top = counts.where(F.col("level") >= least).select("word").collect()       # at most n
    return sorted(w for r in top if len(w := r["word"].encode("utf-8")) <= LONGEST)


_ENCODERS: dict = {}


def encode_decode(docs: DataFrame, tokenizer: str | None = None, lexicon: int = LEXICON,
                  keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` and (ids, decoded) of each row of ``docs``: the ids as little-endian
    unsigned 32-bit integers in a binary, and the text decoded from them."""
    words = frequent_words(docs, lexicon)
    tables = compile_lexicon(words, Merger(vocabulary_path(tokenizer)))
    tag = hashlib.sha1(tables).hexdigest()
    shipped = docs.sparkSession.sparkContext.broadcast(tables)

    def run(batches):
        path = vocabulary_path(tokenizer)
        key = (path, tag)
        if key not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[key] = Encoder(path, shipped.value)
        enc = _ENCODERS[key]
        for b in batches:
            ids = [enc.encode(t) for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(ids, pa.binary()), pa.array([enc.decode(x) for x in ids], pa.string())],
                names=[*keep, "ids", "decoded"])

    schema = docs.select(*keep, F.lit(b"").alias("ids"), F.lit("").alias("decoded")).schema
    return docs.select(*keep, text_of("text").alias("_text")).mapInArrow(run, schema)
