"""Cross-tokenizer alignment of each distinct text.

Rows are grouped by their whole text first; copies are counted map-side, so a text that a third of
all rows share is tokenised once.  Each distinct text is encoded by both vocabularies, and the byte
offsets where tokens of both end cut it into groups.  A link is the pair of tokens that end there
(no token is empty, so there is one on each side).  How often two ids are linked is counted over the
corpus, each text weighted by its number of copies; the measures of a text come from these counts and
are joined to the rows of documents by the SHA-256 of the text.

Looking the counts up needs no shuffle of all links: the most frequent pairs, whole levels of
frequency and ``HOT`` at most, are broadcast.  The other pairs of a text go through a join;
they are rare, so no key of it is hot.

A text is cut into units only before a space that begins a token of either vocabulary whatever stands
around it.  So both sides end there, a unit's tokens and groups are the same in every text, and
those of frequent units are remembered by a worker.  NULL and empty texts, and those that a vocabulary
doesn't give back byte by byte, have no tokens; repeated rows get equal measures; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.common import lookup_join
from .base import stored, text_of
from .bpe import byte_letters, vocabulary_path
from .pretokens import _WS

PART = 1 << 13         # characters of units that are encoded at a time
KNOWN = 400_000        # units that a worker remembers ...
LONGEST = 64           # ... of at most so many characters
HOT = 1 << 18          # pairs that are broadcast, at most
NOTHING = ()           # stands for what a unit without tokens has

_S = _WS.replace(" ", "") + " "
#: A unit begins before a space that no space precedes and that stands behind or before another character than
#: white space; a last space alone would be an empty unit.
_CUT = re.compile(f"(?<! )(?= [^{_S}])|(?<=[^{_S}])(?= (?!\\Z))")
#: Spaces that don't all begin a unit.
_TRICKY = re.compile(f"\\A | \\Z|  |[{_S}] [{_S}]")


def units_of(text: str) -> list[str]:
    """The units of " " + text, without the space that each begins with."""
    if _TRICKY.search(text):
        return [u[1:] for u in _CUT.split(" " + text) if u]
    return text.split(" ")


class _Side:
    """The bytes of a vocabulary's tokens, joined by numbers."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens])
        self.places = np.cumsum(self.sizes) - self.sizes
        self.joined = np.frombuffer(b"".join(tokens), np.uint8)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.sizes[ids])

    def text(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ends):
            return b""
        at = np.repeat(self.places[ids] - ends + sizes, sizes)
        at += np.arange(ends[-1])
        return self.joined[at].tobytes()


class Aligner:
    """Both vocabularies and what an alignment needs of them."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        entries = self.a.get_vocab(with_added_tokens=True)
        tokens = [b""] * (max(entries.values()) + 1)
        for t, i in entries.items():
            tokens[i] = bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode("utf-8")
        self.side_a = _Side(tokens)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.side_b = _Side([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8")
                             for i, p in enumerate(pieces)])
        na, nb = len(tokens), len(pieces)
        # a token's number in decimal with what follows it: , inside its side, | or ; behind it
        self.shown = [f"{i}," for i in range(na)] + [f"{i}|" for i in range(na)]
        self.shown += [f"{i}," for i in range(nb)] + [f"{i};" for i in range(nb)]
        self.na, self.nb = na, nb
        self.known: dict = {}

    def _aligned(self, text: str):
        """(ids of A, ids of B, last tokens of A and of B in each group, ends of groups) of the bytes of
        " " + text; None if they aren't given back."""
        data = (" " + text).encode("utf-8")
        a = np.array(self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, np.int64)
        b = np.array(self.b.encode(text, num_threads=1), np.int64)
        if self.side_b.text(b) != data or self.side_a.text(a) != data:
            return None
        ends_a, ends_b = self.side_a.ends(a), self.side_b.ends(b)
        mark = np.zeros(len(data) + 1, bool)
        mark[ends_b] = True
        last_a = np.flatnonzero(mark[ends_a])
        ends = ends_a[last_a]
        return a, b, last_a, np.searchsorted(ends_b, ends), ends

    def _groups(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``."""
        codes_a, codes_b = a.copy(), b + 2 * self.na
        codes_a[last_a] += self.na
        codes_b[last_b] += self.nb
        group_a = np.searchsorted(last_a, np.arange(len(a)))          # the group of each token
        group_b = np.searchsorted(last_b, np.arange(len(b)))
        codes = np.concatenate([codes_a, codes_b])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        return "".join(map(self.shown.__getitem__, codes[order].tolist()))[:-1]

    def _learn(self, units: list[str], keep: dict) -> None:
        """Adds (tokens of A, tokens of B, groups, links) of each unit, or NOTHING, to ``keep``."""
        found = self._aligned(" ".join(units))
        sizes = np.array([1 + len(u.encode("utf-8")) for u in units])
        if found is not None:
            a, b, last_a, last_b, ends = found
            stops = np.cumsum(sizes)
            to = np.searchsorted(ends, stops) + 1                      # groups up to each unit's end
            if to[-1] == len(ends) and (ends[to - 1] == stops).all():
                groups = self._groups(a, b, last_a, last_b).split(";")
                pairs = a[last_a] << 32 | b[last_b]
                n_a, n_b = np.diff(last_a[to - 1], prepend=-1).tolist(), np.diff(last_b[to - 1], prepend=-1).tolist()
                at = 0
                for u, e, x, y in zip(units, to.tolist(), n_a, n_b):
                    keep[u] = x, y, ";".join(groups[at:e]), pairs[at:e].tobytes()
                    at = e
                return
        if len(units) == 1:
            keep[units[0]] = NOTHING
        else:
            for u in units:
                self._learn([u], keep)

    def align(self, texts: list[str]) -> list:
        """For each text (tokens of A, tokens of B, groups, links as id of A << 32 | id of B), or None without tokens."""
        known = self.known
        if len(known) > KNOWN:
            known.clear()
        cut = [units_of(t) if t else [] for t in texts]
        seen = [list(map(known.get, units)) for units in cut]
        holes = [[k for k, x in enumerate(found) if x is None] if None in found else () for found in seen]
        new = {units[k] for units, at in zip(cut, holes) for k in at}
        held, size, plain = [], 0, {}
        for u in new:
            if u.strip() != u or not u:
                self._learn([u], plain)
                continue
            held.append(u)
            size += len(u) + 1
            if size >= PART:
                self._learn(held, plain)
                held, size = [], 0
        if held:
            self._learn(held, plain)
        known.update((u, x) for u, x in plain.items() if len(u) <= LONGEST)
        out = []
        for units, found, at in zip(cut, seen, holes):
            for k in at:
                found[k] = plain[units[k]]
            if not found or NOTHING in found:
                out.append(None)
                continue
            n_a, n_b, groups, pairs = zip(*found)
            out.append((sum(n_a), sum(n_b), ";".join(groups), np.frombuffer(b"".join(pairs), np.int64)))
        return out


def paths(a: str | None, b: str | None) -> tuple[str, str]:
    if b is None:
        import public_tokenizers
        b = public_tokenizers.path("piece_bpe_32k.model")
    return vocabulary_path(a), b


_ALIGNERS: dict = {}


def aligned(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """(key, copies, n_a, n_b, n_groups, groups_sha256, pairs, times) of each distinct text that isn't empty:
    the linked ids as ``id of A << 32 | id of B``, each once, and how often the text links them."""

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        at = paths(a, b)
        tool = _ALIGNERS.get(at) or _ALIGNERS.setdefault(at, Aligner(*at))
        for batch in batches:
            rows = []
            for found in tool.align(batch.column(0).to_pylist()):
                if found is None:
                    rows.append((0, 0, 0, "", [], []))
                    continue
                n_a, n_b, groups, links = found
                pairs, times = np.unique(links, return_counts=True)
                rows.append((n_a, n_b, len(links), hashlib.sha256(groups.encode()).hexdigest(), pairs, times))
            n_a, n_b, n_groups, shown, pairs, times = zip(*rows) if rows else ((),) * 6
            whole, lists = pa.int64(), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(n_a, whole), pa.array(n_b, whole), pa.array(n_groups, whole),
                 pa.array(shown, pa.string()), pa.array(pairs, lists), pa.array(times, lists)],
                names=["key", "copies", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])

    texts = docs.select(text_of("text").alias("text")).where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    return texts.select("text", _key("text").alias("key"), "copies").mapInArrow(
        run, "key binary, copies bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string,"
             " pairs array<bigint>, times array<bigint>")


def _key(text: str):
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


def pair_counts(texts: DataFrame) -> DataFrame:
    """(pair, n, best) over the corpus: how many links hold the pair, and whether no pair of the same id of B
    has more.  Links are summed by batch before they are shuffled."""

    def add(batches):
        for batch in batches:
            copies = batch.column(0).to_numpy()
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            pairs, at = np.unique(batch.column(1).flatten().to_numpy(), return_inverse=True)
            n = np.zeros(len(pairs), np.int64)
            np.add.at(n, at, batch.column(2).flatten().to_numpy() * np.repeat(copies, sizes))
            yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])

    sums = texts.select("copies", "pairs", "times").mapInArrow(add, "pair bigint, n bigint")
    counts = sums.groupBy("pair").agg(F.sum("n").alias("n"))
    id_b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = counts.groupBy(id_b.alias("id_b")).agg(F.max("n").alias("most"))       # a row for each id of B at most
    return (counts.withColumn("id_b", id_b).join(F.broadcast(most), "id_b")
            .select("pair", "n", (F.col("n") == F.col("most")).alias("best"), F.floor(8 * F.log2("n")).alias("level")))


def frequent_pairs(counts: DataFrame, most: int = HOT) -> tuple[int | None, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The least level of frequency down to which there are at most ``most`` pairs, and those pairs, sorted:
    their numbers, counts and whether they are best."""
    left, least = most, None
    for r in counts.groupBy("level").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("level")).collect():   # a few hundred
        left -= r["k"]
        if left < 0:
            break
        least = r["level"]
    if least is None:
        return None, (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))
    top = counts.where(F.col("level") >= least).select("pair", "n", "best").toArrow()        # at most ``most``
    pairs = top["pair"].to_numpy()
    order = np.argsort(pairs)
    return least, (pairs[order], top["n"].to_numpy()[order], top["best"].to_numpy(zero_copy_only=False)[order])


def alignment(docs: DataFrame, a: str | None = None, b: str | None = None, hot: int = HOT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row of ``docs``."""
    texts = stored(aligned(docs, a, b), "align-texts")
    counts = stored(pair_counts(texts), "align-pairs")
    least, frequent = frequent_pairs(counts, hot)
    shipped = docs.sparkSession.sparkContext.broadcast(frequent)

    def measure(batches):
        known, n_of, best_of = shipped.value
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy()
            rows = np.repeat(np.arange(len(lists)), np.diff(offsets))
            pairs, times = lists.flatten().to_numpy(), batch.column(2).flatten().to_numpy()
            at = np.searchsorted(known, pairs)
            there = at < len(known)
            there[there] = known[at[there]] == pairs[there]
            at, who, times_there = at[there], rows[there], times[there]
            total, best = np.zeros(len(lists), np.int64), np.zeros(len(lists), np.int64)
            np.add.at(total, who, times_there * n_of[at])
            np.add.at(best, who, times_there * best_of[at])
            sizes = np.bincount(rows[~there], minlength=len(lists))
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            rare = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[~there], pa.int64())) for x in (pairs, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best), pa.array(total), *rare],
                                             names=["key", "n_best", "count_sum", "pairs", "times"])

    schema = "key binary, n_best bigint, count_sum bigint, pairs array<bigint>, times array<bigint>"
    found = stored(texts.select("key", "pairs", "times").mapInArrow(measure, schema), "align-measures")
    rare = found.where(F.size("pairs") > 0).select("key", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    rare = rare.select("key", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    others = counts if least is None else counts.where(F.col("level") < least)
    seen = rare.join(others.select("pair", "n", "best"), "pair").select(
        "key", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    sums = (found.select("key", "n_best", "count_sum").unionByName(seen)
            .groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    measures = texts.select("key", "n_a", "n_b", "n_groups", "groups_sha256").join(sums, "key")
    rows = docs.select("doc_id", text_of("text").alias("text")).select(
        "doc_id", F.when(F.col("text") != "", _key("text")).alias("key"))
    whole = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return lookup_join(rows, measures, ["key"]).select(
        "doc_id", whole("n_a"), whole("n_b"), whole("n_groups"), F.coalesce("n_groups", F.lit(0).cast("bigint")).alias("n_links"),
        whole("n_best"), whole("count_sum"), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
