"""N-gram Jaccard self-join with Bayesian candidate pruning.

Shingles are ``SHINGLE`` consecutive words (runs of letters, digits and underscores, lower
case; a shorter text is one shingle).  Texts with the same set of shingles are one class.

1. Each text is sketched: ``BANDS`` bands of ``ROWS`` MinHash values.  At a similarity of
   0.8 a pair shares no band with a probability of (1 - 0.8^5)^48, about 5e-9.
2. Classes that share a band are candidates.  They are not paired: every class is linked to
   the least class of its bucket (aggregated before the shuffle), and the components of
   these links are the units of work, which no candidate pair crosses.  A unit of more than
   ``BLOCK`` classes or ``BLOCK_BYTES`` of text is dealt into blocks at random; each pair of
   blocks is a task's work, so no group, however large, meets in one task.
3. Inside a task, pairs compare their MinHash values ``STEP`` at a time.  With n values
   compared and m of them equal, under a uniform prior the similarity's posterior is
   Beta(m + 1, n - m + 1); a pair is dropped as soon as the probability of 0.8 or more is
   under ``TOLERANCE``.  The rest are verified exactly on their sets.
4. Tasks give back a row per class: how many rows it is linked to and the least class it is
   joined with; never pairs.  Sums and another round of components make the groups.

Texts without words (NULL, empty) are linked to nothing; repeated rows are members of one
class and count as links; NULL ids stay NULL and never name a group that has other ids;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import rows_of, stored, text_of
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 48, 5
HASHES, STEP = 256, 32
TOLERANCE = 1e-9
BLOCK = 512
BLOCK_BYTES = 16 << 20

_WORD = re.compile(r"\w+")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _M2
    return h ^ (h >> np.uint64(29))


class WordHashes(dict):
    """Word -> 64-bit hash, remembered for words of at most 256 characters."""

    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:
            self.clear()
        h = int.from_bytes(hashlib.blake2b(word.encode("utf-8"), digest_size=8).digest(), "little")
        if len(word) <= 256:
            self[word] = h
        return h


def shingles(text: str, known: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's shingles."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - size + 1)
    out = np.full(n, len(words) if len(words) < size else size, np.uint64)
    for k in range(min(size, len(words))):
        out = _mixed(out * _M1 + h[k:k + n])
    return np.unique(out)


@lru_cache(8)
def _permutations(n: int, seed: int = 11):
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1),
            rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32))


def min_hashes(sets: np.ndarray, n: int, seed: int = 11) -> np.ndarray:
    """``n`` MinHash values of a non-empty set of hashes."""
    a, b = _permutations(n, seed)
    x = (sets >> np.uint64(32)).astype(np.uint32) ^ sets.astype(np.uint32)
    out = np.full(n, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 256):
        part = x[k:k + 256]
        v = part[None, :] * a[:, None]
        v += b[:, None]
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x2C1B3C6D)
        np.minimum(out, v.min(axis=1), out=out)
    return out


@lru_cache(8)
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
                  hashes: int = HASHES, step: int = STEP) -> tuple[int, ...]:
    """After step, 2 * step, ... values: the least matches for which the posterior probability of
    ``threshold`` or more is ``tolerance`` at least.  P(Beta(m+1, n-m+1) >= t) = P(Bin(n+1, t) <= m)."""
    out = []
    for n in range(step, hashes + 1, step):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, h, id, check, n_bytes, bands): the hash of the text, 128 bits of its set of shingles as two numbers
    (NULL without words) and the keys of its bands."""

    def run(batches):
        known = WordHashes()
        for b in batches:
            r = rows_of(b)
            ids, checks, sizes, bands = [], [], [], []
            for t in r["text"]:
                s = shingles(t, known)
                sizes.append(len(t))
                if not len(s):
                    ids.append(None)
                    checks.append(None)
                    bands.append([])
                    continue
                name = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                ids.append(int.from_bytes(name[:8], "little", signed=True))
                checks.append(int.from_bytes(name[8:], "little", signed=True))
                m = min_hashes(s, BANDS * ROWS).reshape(BANDS, ROWS)
                key = np.arange(BANDS, dtype=np.uint64)
                for k in range(ROWS):
                    key = _mixed(key * _M1 + m[:, k])
                bands.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(ids, pa.int64()), pa.array(checks, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "h", "id", "check", "n_bytes", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = text_of("text")
    return docs.select("doc_id", F.xxhash64(text).alias("h"), text.alias("text")).mapInArrow(
        run, f"doc_id {kind}, h bigint, id bigint, check bigint, n_bytes bigint, bands array<bigint>")


def told_apart(rows: DataFrame) -> DataFrame:
    """``rows`` with an id for each different (id, check): sets whose first 64 bits meet, about three pairs among 10^10
    documents, are named by a hash of all 128.  The least check keeps its id."""
    clashes = stored(rows.where("id is not null").groupBy("id").agg(F.min("check").alias("least"), F.max("check").alias("last"))
                     .where("least < last").select("id", "least"), "jaccard-clashes")
    other = F.col("least").isNotNull() & (F.col("check") != F.col("least"))
    return (rows.join(clashes, "id", "left")
            .withColumn("id", F.when(other, F.xxhash64("id", "check")).otherwise(F.col("id"))).select(*rows.columns))


# --- one unit of work ----------------------------------------------------------------------

def linked_pairs(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, same: bool,
                 threshold: float = THRESHOLD):
    """Index pairs of ``left`` x ``right`` (i < j if both are the ``same``) whose sets are
    at least ``threshold`` similar: pruned by MinHash values, verified on the sets."""
    everyone = np.concatenate([left] if same else [left, right])
    sketch = {int(i): min_hashes(sets[i], HASHES, seed=23) for i in everyone}
    a = np.stack([sketch[int(i)] for i in left])
    b = np.stack([sketch[int(j)] for j in right])
    lows = least_matches(threshold)
    # shingles of the right side as dense numbers, for counting intersections by marks
    flat = np.concatenate([sets[j] for j in right])
    values, dense = np.unique(flat, return_inverse=True)
    sizes = np.array([len(sets[j]) for j in right])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    mark = np.zeros(len(values), np.int32)
    for x, i in enumerate(left):
        js = np.arange(x + 1 if same else 0, len(right))
        matches = np.zeros(len(js), np.int32)
        for k, low in enumerate(lows):
            if not len(js):
                break
            at = slice(k * STEP, (k + 1) * STEP)
            matches += (b[js, at] == a[x, at]).sum(axis=1)
            stay = matches >= low
            js, matches = js[stay], matches[stay]
        if not len(js):
            continue
        mine = np.searchsorted(values, sets[i])
        mine = mine[mine < len(values)]
        mine = mine[np.isin(values[mine], sets[i], assume_unique=True)]
        mark[mine] = 1
        if 4 * sizes[js].sum() >= len(flat):
            common = np.add.reduceat(mark[dense], starts[:-1])[js]
        else:
            common = np.array([mark[dense[starts[j]:starts[j + 1]]].sum() for j in js])
        mark[mine] = 0
        union = len(sets[i]) + sizes[js] - common
        for j in js[common >= threshold * union - 1e-9]:
            yield x, int(j)


def unit_rows(members: list[tuple[int, int, int, str]], known: WordHashes):
    """The classes of a unit's rows (block, id, size, text): ids, blocks, sizes and shingles."""
    ids, blocks, weights, sets = [], [], [], []
    for (block, id_), (weight, text) in {(b, i): (n, t) for b, i, n, t in members}.items():   # a repeated row comes once
        ids.append(id_)
        blocks.append(block)
        weights.append(weight)
        sets.append(shingles(text, known))
    return ids, np.array(blocks), weights, sets


def compare_units(rows):
    """Batches of (unit, p, q, block, id, size, text), sorted by unit -> batches of results."""
    known = WordHashes()
    out: list[tuple[int, int, int]] = []

    def finish(p, q, members):
        ids, blocks, weights, sets = unit_rows(members, known)
        left, right = np.flatnonzero(blocks == p), np.flatnonzero(blocks == q)
        if len(left) == 0 or len(right) == 0:
            return
        links, root = dict.fromkeys(ids, 0), {i: i for i in ids}

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for x, y in linked_pairs(sets, left, right, p == q):
            i, j = left[x], right[y]
            links[ids[i]] += weights[j]
            links[ids[j]] += weights[i]
            a, b = find(ids[i]), find(ids[j])
            if a != b:
                root[max(a, b)] = min(a, b)
        out.extend((i, n, find(i)) for i, n in links.items() if n)

    def batch():
        cols = list(zip(*out)) or [[], [], []]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["id", "links", "root"])

    unit, members = None, []
    for b in rows:
        r = rows_of(b)
        for u, p, q, block, id_, n, text in zip(r["unit"], r["p"], r["q"], r["block"], r["id"], r["size"], r["text"]):
            if (u, p, q) != unit:
                if members:
                    finish(unit[1], unit[2], members)
                unit, members = (u, p, q), []
            members.append((block, id_, n, text))
        if len(out) > 5000:
            yield batch()
    if members:
        finish(unit[1], unit[2], members)
    yield batch()


# --- the join ------------------------------------------------------------------------------

def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, h, class_id, group_id, n_links, n_same, group_key) of each row of ``docs`` (doc_id, text).

    class_id: least doc_id with the same shingles; group_id: least doc_id of all that are linked
    directly or through others; n_links: other rows that are 0.8 or more similar; h: xxhash64 of
    the text; n_same: rows of ``docs`` with the same doc_id and text; group_key: a key of the group
    (for texts without words, of the text).
    """
    spark = docs.sparkSession
    rows = told_apart(stored(sketches(docs), "jaccard-sketches"))
    worded = rows.where("id is not null")
    classes = worded.groupBy("id").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("size"),
                                       F.max("n_bytes").alias("n_bytes"),
                                       F.min(F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "h")).alias("pick"))
    bands = worded.select("id", F.explode("bands").alias("band"))
    buckets = (bands.groupBy("band").agg(F.min("id").alias("root"), F.max("id").alias("last"))
               .where("root < last").select("band", "root"))
    stars = bands.join(buckets.hint("merge"), "band").where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))
    found = stored(components(stars), "jaccard-units")

    # units of classes, dealt into blocks by size
    members = stored(found.join(classes, "id"), "jaccard-members")
    blocks = members.groupBy("root").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_bytes") / BLOCK_BYTES)).cast("int").alias("blocks"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    # joined by sorting whatever the sizes: the units grow with the texts
    texts = docs.select(key.alias("_k"), F.xxhash64(text_of("text")).alias("_h"), text_of("text").alias("text")).hint("merge")
    dealt = (members.join(blocks, "root")
             .select("id", "size", F.col("root").alias("unit"), "blocks", F.col("pick.col1").alias("_k"), F.col("pick.h").alias("_h"),
                     F.pmod(F.xxhash64(F.lit("deal"), "id"), F.col("blocks")).cast("int").alias("block"))
             .join(texts, ["_k", "_h"])
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("unit", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
                     "block", "id", "size", "text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    results = stored(dealt.repartition(parts, "unit", "p", "q").sortWithinPartitions("unit", "p", "q")
                     .mapInArrow(compare_units, "id bigint, links bigint, root bigint"), "jaccard-links")

    links = results.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(results.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = (groups.join(classes.select("id", "class_id"), "id")
             .groupBy("root").agg(F.min("class_id").alias("group_id")))
    per_class = (classes.select("id", "class_id", "size").join(links, "id", "left")
                 .join(groups.join(named, "root").select("id", "root", "group_id"), "id", "left")
                 .select("id", "class_id", F.coalesce("root", "id").alias("group_key"),
                         F.coalesce("group_id", "class_id").alias("group_id"),
                         (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")))
    same = (rows.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n_same")).where("n_same > 1")
            .select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), "n_same"))
    return (rows.select("doc_id", "h", "id").join(per_class, "id", "left")
            .join(same, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")), "left")
            .select("doc_id", "h", F.coalesce("class_id", "doc_id").alias("class_id"),
                    F.coalesce("group_id", "doc_id").alias("group_id"),
                    F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                    F.coalesce("n_same", F.lit(1)).cast("bigint").alias("n_same"),
                    F.coalesce("group_key", "h").alias("group_key")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that of its least doc_id (NULL comes
    last; of rows with the same id, that of the least text hash; of equal rows, one).  Equal texts
    without words are such a group too."""
    lead = (near_duplicates(docs).groupBy("group_key")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "n_same")).alias("r"))
            .select(F.col("r.doc_id").alias("id"), F.col("r.h").alias("h"), F.col("r.n_same").alias("n")))
    # the caller's columns travel as one, so their names can't meet those of the join
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("own_id"), F.xxhash64(text_of("text")).alias("own_h"))
    kept = packed.join(lead, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_h") == F.col("h")))
    once = kept.where("n = 1").select("row.*")
    again = kept.where("n > 1").dropDuplicates(["id", "h"]).select("row.*")
    return once.union(again)
