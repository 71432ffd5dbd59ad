"""Suffix-array dedup: bytes inside long strings that also start elsewhere.

A string of ``LENGTH`` bytes is repeated if it starts at two places of the corpus, in one
text or in several; every byte it covers is a repeated byte.

1. Anchors.  Each window of LENGTH bytes has an anchor: of its grams of ``GRAM`` bytes the one
   with the least hash (ties: the last).  The anchor depends on the window's bytes alone, so
   equal windows have equal anchors at equal places.  Neighbouring windows share anchors; such
   a run is one block, about two for every LENGTH - GRAM bytes.  Two windows can only be equal
   if their anchors' grams are, so only blocks whose gram occurs again go on.
2. Blocks that are equal as a whole are folded into one weighted block, aggregated before the
   shuffle: a group of copies, however large, is a single suffix.  All windows of a block that
   occurs twice are repeated.
3. For the others, the suffixes at the anchors of a gram are sorted, and so are the reversed
   prefixes, deep-shallow: multikey quicksort (8 bytes a step) to a shallow depth, blind tries
   for groups that share more.  With the common prefixes of neighbours, a window that starts j
   bytes before its anchor is repeated exactly if another suffix shares j bytes to the left and
   LENGTH - j to the right.
4. A gram with more than ``GROUP`` different blocks is never sorted in one task: its blocks are
   cut at fixed offsets into runs of fewer windows, regrouped by the bytes all windows of the
   run share, and folded again; at one window a run every group is a single folded block.

Texts are taken as UTF-8 bytes, NULL as empty; texts shorter than LENGTH have no repeats;
repeated rows repeat each other; other columns pass through.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import rows_of, stored, text_of

LENGTH = 400
GRAM = 128
SHALLOW = 32           # bytes that multikey quicksort looks at
GROUP = 2048           # different blocks of a gram that one task sorts
CUTS = (32, 4, 1)      # windows of a run, in the rounds for larger groups
CHUNK = 4 << 20        # bytes that are hashed at a time

_B, _C = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64((1 << 24) - 1)


# --- anchors -------------------------------------------------------------------------------

def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash for each gram of ``data``, by doubling."""
    rng = np.random.default_rng(5)
    h = rng.integers(0, 1 << 63, 256, dtype=np.uint64)[data]
    span, power = 1, _B
    while span < gram:                                   # gram is a power of two
        g = h[:-span] * np.uint64(power)
        g += h[span:]
        h = g
        span, power = span * 2, power * power % (1 << 64)
    h ^= h >> np.uint64(32)
    h *= _C
    h ^= h >> np.uint64(29)
    return h


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(anchor of each window, hash of each gram); ``data`` has under 2^24 bytes."""
    keys = gram_hashes(data, gram)
    v = (keys & ~_LOW) | (_LOW - np.arange(len(keys), dtype=np.uint64))      # ties: the last wins
    width, span = length - gram + 1, 1
    while span * 2 <= width:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    if span < width:
        v = np.minimum(v[:span - width], v[width - span:])
    return (_LOW - (v & _LOW)).astype(np.int64), keys


def _pieces(sizes: list[int], length: int):
    """Lists of (row, first byte, end) whose bytes are hashed together; huge rows are cut so that
    each window lies in one piece."""
    most, out, held = (1 << 24) - 1, [], 0
    for row, n in enumerate(sizes):
        if n < length:
            continue
        for at in range(0, n - length + 1, most - length + 1):
            end = min(n, at + most)
            if out and held + end - at > CHUNK:
                yield out
                out, held = [], 0
            out.append((row, at, end))
            held += end - at
    if out:
        yield out


def blocks_of(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """Arrays (row, anchor, first window, last window, gram hash) of all blocks of ``texts``."""
    parts = []
    for piece in _pieces([len(t) for t in texts], length):
        data = np.frombuffer(b"".join(texts[r][a:e] for r, a, e in piece), np.uint8)
        anchor, keys = anchors(data, length, gram)
        starts = np.cumsum([0] + [e - a for _, a, e in piece])
        valid = np.zeros(len(anchor) + 1, bool)
        for k in range(len(piece)):
            valid[starts[k]:starts[k + 1] - length + 1] = True
        new = np.empty(len(anchor), bool)
        new[0] = True
        np.not_equal(anchor[1:], anchor[:-1], out=new[1:])
        new[1:] |= ~valid[:-2]
        first = np.flatnonzero(new & valid[:-1])
        ends = np.flatnonzero(valid[:-1] & (np.append(new[1:], True) | ~valid[1:]))
        which = np.searchsorted(starts, first, side="right") - 1
        rows = np.array([r for r, _, _ in piece])[which]
        shift = np.array([a for _, a, _ in piece])[which] - starts[which]
        parts.append((rows, anchor[first] + shift, first + shift, ends + shift, keys[anchor[first]].view(np.int64)))
    if not parts:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _digest(data: bytes, lead: int) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8, salt=lead.to_bytes(8, "little")).digest(), "little", signed=True)


_BLOCK = "u bigint, v int, r int, anchor int, first int, last int, gram bigint, block bigint"


def all_blocks(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """The blocks of all texts: u and v name the text, r the row."""

    def run(batches):
        for b in batches:
            r = rows_of(b)
            texts = [t.encode("utf-8") for t in r["text"]]
            rows, anchor, first, last, keys = blocks_of(texts, length, gram)
            blocks = [_digest(texts[i][p:q + length], a - p) for i, a, p, q in
                      zip(rows.tolist(), anchor.tolist(), first.tolist(), last.tolist())]
            at = pa.array(rows)
            ints = [pa.array(x, pa.int32()) for x in (anchor, first, last)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at), b.column(2).take(at), *ints, pa.array(keys, pa.int64()),
                 pa.array(blocks, pa.int64())], names=[c.split(" ")[0] for c in _BLOCK.split(", ")])

    return docs.select("_u", "_v", "_r", "text").mapInArrow(run, _BLOCK)


# --- deep-shallow sorting ------------------------------------------------------------------

def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class _Node:
    """A branch of a blind trie: the number of bytes skipped to it, and what follows by the byte
    there (-1: the suffix ends).  Leaves are lists of equal suffixes."""
    __slots__ = ("depth", "next")

    def __init__(self, depth):
        self.depth, self.next = depth, {}


def blind_trie_order(items: list[int], s: list[bytes]) -> list[int]:
    """``items`` in the order of their suffixes: each is led down the trie by single bytes,
    compared once with the leaf it comes to, and put in where they part."""
    root = [items[0]]
    for i in items[1:]:
        x = s[i]
        node, path = root, []
        while isinstance(node, _Node):
            c = x[node.depth] if node.depth < len(x) else -1
            path.append((node, c))
            node = node.next.get(c) or next(iter(node.next.values()))
        y = s[node[0]]
        d = common(x, y)
        if d == len(x) == len(y):
            node.append(i)
            continue
        above, below = None, root
        for n, c in path:
            if n.depth >= d:
                break
            above = (n, c)
            below = n.next.get(c)
        cx = x[d] if d < len(x) else -1
        if isinstance(below, _Node) and below.depth == d:
            below.next[cx] = [i]
            continue
        split = _Node(d)
        split.next = {cx: [i], (y[d] if d < len(y) else -1): below}
        if above is None:
            root = split
        else:
            above[0].next[above[1]] = split
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, _Node):
            stack.extend(node.next[c] for c in sorted(node.next, reverse=True))
        else:
            out.extend(node)
    return out


def suffix_order(s: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """The order of the suffixes ``s``: multikey quicksort down to ``shallow`` bytes, blind tries
    for the groups that are equal so far."""
    out, todo = [], [(list(range(len(s))), 0)]
    while todo:
        group, depth = todo.pop()
        if len(group) < 2:
            out.extend(group)
        elif depth >= shallow:
            out.extend(blind_trie_order(group, s))
        else:
            pivot = s[group[len(group) // 2]][depth:depth + 8]
            less, same, more = [], [], []
            for i in group:
                c = s[i][depth:depth + 8]
                (same if c == pivot else less if c < pivot else more).append(i)
            todo.append((more, depth))
            todo.append((same, depth + 8) if len(pivot) == 8 else (same, shallow))
            todo.append((less, depth))
    return out


def _classes(order: list[int], lcp: list[int], least: int) -> list[int]:
    """For each suffix the number of its class: neighbours in order that share ``least`` bytes."""
    out, k = [0] * len(order), 0
    for at, i in enumerate(order):
        if at and lcp[at - 1] < least:
            k += 1
        out[i] = k
    return out


def repeated_windows(lefts: list[bytes], rights: list[bytes], runs: list[tuple[int, int]], length: int = LENGTH):
    """For each block, the ranges [j, j'] of its windows (bytes before the anchor) that another
    block holds too.  ``lefts``: bytes before the anchor, reversed; ``rights``: from it on;
    ``runs``: least and largest j of each block."""
    n = len(lefts)
    order_l, order_r = suffix_order(lefts), suffix_order(rights)
    lcp_l = [common(lefts[a], lefts[b]) for a, b in zip(order_l, order_l[1:])]
    lcp_r = [common(rights[a], rights[b]) for a, b in zip(order_r, order_r[1:])]
    low, high = min(r[0] for r in runs), max(r[1] for r in runs)
    # the classes change only after a common prefix's end
    steps = sorted({low} | {x + 1 for x in lcp_l if low <= x < high} | {length - x for x in lcp_r if low < length - x <= high})
    found: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for j, end in zip(steps, [x - 1 for x in steps[1:]] + [high]):
        of_l, of_r = _classes(order_l, lcp_l, j), _classes(order_r, lcp_r, length - j)
        groups: dict[tuple[int, int], list[int]] = {}
        for i in range(n):
            # a block that is too short on a side has no such window
            if len(lefts[i]) >= j and len(rights[i]) >= length - j:
                groups.setdefault((of_l[i], of_r[i]), []).append(i)
        for g in groups.values():
            if len(g) > 1:
                for i in g:
                    a, b = max(j, runs[i][0]), min(end, runs[i][1])
                    if a <= b:
                        found[i].append((a, b))
    return found


def sort_groups(length: int):
    """Batches of (gram, times, low, high, left, right, u, v, anchor), sorted by gram -> repeated
    byte ranges of the blocks that occur once."""

    def run(batches):
        out: list[tuple] = []

        def batch():
            cols = list(zip(*out)) or [[], [], [], []]
            out.clear()
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["u", "v", "start", "stop"])

        def finish(group):
            # the gram hash may gather different grams: the right sides are compared whole
            if len(group) < 2 or all(g[1] > 1 for g in group):
                return
            found = repeated_windows([g[4] for g in group], [g[5] for g in group], [(g[2], g[3]) for g in group], length)
            for g, ranges in zip(group, found):
                if g[1] == 1:
                    out.extend((g[6], g[7], g[8] - b, g[8] - a + length) for a, b in ranges)

        def rows():
            for b in batches:
                r = rows_of(b)
                yield from zip(r["gram"], r["times"], r["low"], r["high"], r["left"], r["right"], r["u"], r["v"], r["anchor"])

        for _, group in groupby(rows(), key=lambda g: g[0]):
            finish(list(group))
            if len(out) > 5000:
                yield batch()
        yield batch()

    return run


def cut_contexts(length: int):
    """Texts with their picked blocks -> blocks with the bytes around their anchors."""

    def run(batches):
        for b in batches:
            r = rows_of(b)
            out = []
            for u, v, text, picked in zip(r["u"], r["v"], r["text"], r["picked"]):
                data = text.encode("utf-8")
                for p in picked:
                    a, first, last = p["anchor"], p["first"], p["last"]
                    out.append((p["gram"], p["times"], a - last, a - first, data[first:a][::-1], data[a:last + length], u, v, a))
            yield _contexts(out)

    return run


_CONTEXT = "gram bigint, times bigint, low int, high int, left binary, right binary, u bigint, v int, anchor int"


def _contexts(rows) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int32()]
    cols = list(zip(*rows)) or [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      names=[c.split(" ")[0] for c in _CONTEXT.split(", ")])


def cut_runs(length: int, windows: int):
    """Blocks of crowded grams -> runs of at most ``windows`` windows at fixed offsets, regrouped by
    the bytes that all windows of a run share; ``block`` names the run's bytes."""

    def run(batches):
        for b in batches:
            out, names = [], []
            for row in zip(*(c.to_pylist() for c in b.columns)):
                gram, times, low, high, left, right, u, v, anchor = row[:9]
                at = low
                while at <= high:
                    start = at - at % windows
                    end = min(high, start + windows - 1)
                    # what all windows of the full run share: ``start`` bytes before the anchor, and after it ...
                    key = _digest(left[:start][::-1] + right[:max(0, length - start - windows + 1)], start)
                    out.append((key, times, at, end, left[:end], right[:length - at], u, v, anchor))
                    names.append(_digest(left[:end][::-1] + right[:length - at], end))
                    at = end + 1
            batch = _contexts(out)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.int64())], names=[*batch.schema.names, "block"])

    return run


# --- the operator --------------------------------------------------------------------------

def _named(docs: DataFrame) -> DataFrame:
    """``docs`` with names of the text (_u, _v) and of the row (_r)."""
    text = text_of("text")
    return docs.select("*", F.xxhash64(text).alias("_u"), F.hash(text).alias("_v"), F.hash("doc_id").alias("_r"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = GROUP) -> DataFrame:
    """(u, v, spans): for each text with repeats, named by xxhash64 and hash, byte ranges that
    repeated strings cover; they may touch and overlap."""
    spark = docs.sparkSession
    named = _named(docs.select("doc_id", text_of("text").alias("text")))
    blocks = all_blocks(named, length, gram)
    # stored, so that the join below is between two exchanges and a gram with very many blocks is split
    grams = stored(blocks.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "spans-grams")
    shared = stored(blocks.join(grams, "gram", "left_semi"), "spans-blocks")

    one = lambda c: F.first(c).alias(c)  # noqa: E731  all from the same row: any row of the block will do
    folded = stored(shared.groupBy("gram", "block").agg(F.count(F.lit(1)).alias("times"), *map(one, ("u", "v", "r", "anchor", "first", "last"))),
                    "spans-folded")
    repeats = folded.where("times > 1").select("gram", "block")
    whole = (shared.join(repeats, ["gram", "block"], "left_semi")
             .select("u", "v", F.col("first").alias("start"), (F.col("last") + length).alias("stop")).distinct())

    kinds = (folded.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"), F.min("times").alias("least"))
             .where("kinds > 1 and least = 1").select("gram", "kinds"))
    picked = (folded.join(kinds.select("gram"), "gram", "left_semi")
              .groupBy("u", "v", "r").agg(F.collect_list(F.struct("gram", "times", "anchor", "first", "last")).alias("picked")))
    texts = named.select(F.col("_u").alias("u"), F.col("_v").alias("v"), F.col("_r").alias("r"), "text")
    contexts = stored(texts.join(picked, ["u", "v", "r"]).mapInArrow(cut_contexts(length), _CONTEXT)
                      .dropDuplicates(["gram", "u", "v", "anchor", "low"]), "spans-contexts")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = lambda df: (df.repartition(parts, "gram").sortWithinPartitions("gram")
                       .mapInArrow(sort_groups(length), "u bigint, v int, start int, stop int"))
    crowded = kinds.where(F.col("kinds") > crowd).select("gram")
    out = whole.union(sort(contexts.join(crowded, "gram", "left_anti")))

    names = [c.split(" ")[0] for c in _CONTEXT.split(", ")]
    left = contexts.join(crowded, "gram", "left_semi").select(*names)
    for windows in CUTS:
        runs = stored(left.mapInArrow(cut_runs(length, windows), _CONTEXT + ", block bigint"), "spans-runs")
        if runs.isEmpty():
            break
        kinds = runs.groupBy("gram", "block").agg(F.sum("times").alias("n"))
        twice = kinds.where("n > 1").select("gram", "block")
        out = out.union(runs.where("times = 1").join(twice, ["gram", "block"], "left_semi")
                        .select("u", "v", (F.col("anchor") - F.col("high")).alias("start"),
                                (F.col("anchor") - F.col("low") + length).alias("stop")))
        folded = runs.groupBy("gram", "block").agg(F.sum("times").alias("times"), *map(one, ("low", "high", "left", "right", "u", "v", "anchor")))
        open_ = (kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
                 .where("kinds > 1 and least = 1").select("gram", "kinds"))
        folded = stored(folded.join(open_, "gram").select(*names, "kinds"), "spans-runs")
        out = out.union(sort(folded.where(F.col("kinds") <= crowd).select(*names)))
        left = folded.where(F.col("kinds") > crowd).select(*names)
    return (out.distinct().groupBy("u", "v").agg(F.collect_list(F.struct("start", "stop")).alias("spans")))


def merged(spans) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that ``spans`` cover."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without_repeats(docs: DataFrame, length: int = LENGTH, columns: list[str] | None = None,
                    crowd: int = GROUP, gram: int = GRAM, as_bytes: bool = True) -> DataFrame:
    """The columns of ``docs`` (or those given; any named like a result is replaced) and kept (binary: the remaining bytes; empty unless
    ``as_bytes``), kept_text (the same as text, without the broken characters that a cut inside one leaves), n_bytes, removed
    (array of maximal byte ranges)."""
    results = ("kept", "kept_text", "n_bytes", "removed")
    columns = [c for c in (docs.columns if columns is None else columns) if c not in results]
    spans = repeated_spans(docs, length, gram, crowd)
    # the caller's columns travel as one, so their names can't meet those of the join
    text = text_of("text")
    packed = docs.select(F.struct(*columns).alias("row"), text.alias("text"), F.xxhash64(text).alias("u"), F.hash(text).alias("v"))
    made = packed.join(spans, ["u", "v"], "left").select("row.*", F.col("text").alias("__text"), F.col("spans").alias("__spans"))
    n = len(columns)

    def run(batches):
        for b in batches:
            kept, texts, sizes, removed = [], [], [], []
            for text, spans in zip(b.column(n).to_pylist(), b.column(n + 1).to_pylist()):
                data = text.encode("utf-8")
                runs = merged([(x["start"], x["stop"]) for x in spans or []])
                at, left = 0, []
                for a, e in runs:
                    left.append(data[at:a])
                    at = e
                left.append(data[at:])
                kept.append(b"".join(left) if as_bytes else b"")
                texts.append("".join(x.decode("utf-8", "ignore") for x in left))
                sizes.append(len(data))
                removed.append([{"start": a, "stop": e} for a, e in runs])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k) for k in range(n)), pa.array(kept, pa.binary()), pa.array(texts, pa.string()), pa.array(sizes, pa.int64()),
                 pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))],
                names=[*columns, "kept", "kept_text", "n_bytes", "removed"])

    schema = docs.select(*columns, F.lit(b"").alias("kept"), F.lit("").alias("kept_text"), F.lit(0).cast("bigint").alias("n_bytes"),
                         F.lit(None).cast("array<struct<start:int,stop:int>>").alias("removed")).schema
    return made.mapInArrow(run, schema)
