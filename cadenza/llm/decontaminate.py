"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts are lower-cased (A-Z) and reduced to words.  The patterns are all windows of
``WINDOW`` consecutive words of each benchmark item (a shorter item is one window).
With m the least pattern length and B the block length, a table says for each block
of the patterns' first m bytes how far it is from their end; any other block lets the
search jump m - B + 1 bytes.  Blocks at distance 0 lead to the bucket of patterns with
that suffix block, which are compared directly.  Short and long patterns are searched
apart, so that a short item doesn't shorten the jumps of all others.

The benchmark is searched in blocks of about ``BLOCK_BYTES`` of text, each broadcast
(so its size is bounded).  If there are several, the texts are written once and read for each block,
whose hits alone are written; the hits of all blocks come together by row.

Nulls and texts without words have no hits; equal rows get equal results; repeated
benchmark rows count once; an item whose id is NULL counts under the empty id; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import rows_of, stored, text_of

WINDOW = 10
BLOCK_BYTES = 1 << 20
_SPANS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
LONG = 24              # bytes from which a pattern counts as long

_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"       # a word before lower-casing

_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
               for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(_TABLE).split()


def windows_of(words: list[bytes], window: int = WINDOW) -> list[bytes]:
    if not words:
        return []
    return [b" %s " % b" ".join(words[k:k + window]) for k in range(max(1, len(words) - window + 1))]


class WuManber:
    """Shift tables, suffix buckets and comparison for patterns of at least one byte."""

    def __init__(self, patterns):
        self.m = m = min(map(len, patterns))
        self.b = b = max(1, min(8, m // 2))
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, list[bytes]] = defaultdict(list)
        for p in patterns:
            for j in range(m - b + 1):
                block, far = p[j:j + b], m - b - j
                if far < self.shift.get(block, m):
                    self.shift[block] = far
            self.bucket[p[m - b:m]].append(p)

    def find(self, line: bytes):
        """(offset, pattern) of every occurrence."""
        m, shift, bucket = self.m, self.shift.get, self.bucket
        off, jump = m - self.b, m - self.b + 1
        i, end = 0, len(line) - m
        while i <= end:
            block = line[i + off:i + m]
            far = shift(block, jump)
            if far:
                i += far
                continue
            for p in bucket[block]:
                if line.startswith(p, i):
                    yield i, p
            i += 1


class Searcher:
    """All windows of a block of items."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        owners = defaultdict(set)
        for item, text in items:
            for p in windows_of(words_of(text), window):
                owners[p].add(item)
        self.owners = {p: sorted(x) for p, x in owners.items()}
        parts = [p for p in owners if len(p) >= LONG], [p for p in owners if len(p) < LONG]
        self.tables = [WuManber(x) for x in parts if x]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges of occurrences, and the items they come from."""
        line = b" %s " % b" ".join(words)
        spans, items = [], set()
        for t in self.tables:
            seen = at = 0
            for i, p in t.find(line):
                seen += line.count(b" ", at, i)
                at = i
                spans.append((seen, seen + p.count(b" ") - 1))
                items.update(self.owners[p])
        return spans, items


def merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def in_runs(items: DataFrame, window: int, run_bytes: int) -> DataFrame:
    """``items`` (item, text) with each text of more than ``run_bytes`` cut into runs of whole words of about so
    many bytes; a run goes on for ``window`` - 1 words into the next, so each window stands in one of them."""
    words = F.regexp_extract_all("text", F.lit(_WORD), F.lit(0))
    long = F.octet_length("text") > run_bytes
    some = items.where(long).select("item", "text", words.alias("w"))
    step = F.greatest(F.lit(1), F.floor(F.size("w") * F.lit(run_bytes) / F.octet_length("text"))).cast("int")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - F.lit(window - 1)), step)
    cut = some.select("item", "w", step.alias("n"), F.explode(starts).alias("at")).select(
        "item", F.array_join(F.slice("w", F.col("at"), F.col("n") + F.lit(window - 1)), " ").alias("text"))
    return items.where(~long).unionByName(cut)


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, window: int = WINDOW):
    """The distinct items in lists of about ``block_bytes`` of text; a list at a time is held.  Texts are dealt by
    item and text, long ones in runs, so an item id that holds much of the benchmark is spread over lists."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             text_of("text").alias("text")).distinct()
    items = in_runs(items, window, max(1, block_bytes // 4))
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, math.ceil(size / block_bytes))
    for k in range(n):
        yield [(r["item"], r["text"]) for r in
               items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()]   # one bounded block


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES, keep: list[str] | None = None) -> DataFrame:
    """The columns of ``docs`` (or those of ``keep``; any named like a result is replaced) and n_words, hit_spans (merged word ranges
    [start, end) inside occurrences of windows) and hit_items (sorted item ids as strings)."""
    found = ["n_words", "hit_spans", "hit_items"]
    spark, keep = docs.sparkSession, [c for c in (docs.columns if keep is None else keep) if c not in found]
    kinds = "n_words bigint, hit_spans array<struct<a:bigint,b:bigint>>, hit_items array<string>"

    def search(shipped, back, text, hits_only=False):
        """Of each row the first ``back`` columns and what is found in its text, column ``text``."""
        def run(batches):
            searcher = Searcher(shipped.value, window)
            for b in batches:
                counts, all_spans, all_items = [], [], []
                for t in b.column(text).to_pylist():
                    words = words_of(t or "")
                    s, i = searcher.hits(words)
                    counts.append(len(words))
                    all_spans.append([{"a": x, "b": y} for x, y in merged(s)])
                    all_items.append(sorted(i))
                new = [pa.array(counts, pa.int64()), pa.array(all_spans, _SPANS), pa.array(all_items, pa.list_(pa.string()))]
                out = pa.RecordBatch.from_arrays([*(b.column(k) for k in range(back)), *new], names=[*b.schema.names[:back], *found])
                yield out.filter(pc.greater(pc.list_value_length(out.column("hit_spans")), 0)) if hits_only else out
        return run

    def merge(batches):
        for b in batches:
            r = rows_of(b)
            spans = [[{"a": x, "b": y} for x, y in merged((s["a"], s["b"]) for s in row)] for row in r["hit_spans"]]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(spans, _SPANS), pa.array(map(sorted, map(set, r["hit_items"])), pa.list_(pa.string()))],
                                             names=["at", *found])

    blocks = item_blocks(benchmark, block_bytes, window)
    items, later = next(blocks), next(blocks, None)
    if later is None:
        texts = docs.select(*dict.fromkeys([*keep, "text"]))
        out = docs.select(*keep, *(F.lit(None).cast(t).alias(c) for c, t in zip(found, ("bigint", "array<struct<a:bigint,b:bigint>>", "array<string>"))))
        return texts.mapInArrow(search(spark.sparkContext.broadcast(items), len(keep), texts.columns.index("text")), out.schema)
    # the texts are written once, with a number for each row; of each block only the hits are
    rows = stored(docs.select(F.struct(*keep).alias("row"), text_of("text").alias("text"), F.monotonically_increasing_id().alias("at")), "decontaminate")
    parts, first = [], True
    while items is not None:
        shipped = spark.sparkContext.broadcast(items)
        part = rows.select("at", "text").mapInArrow(search(shipped, 1, 1, not first), f"at bigint, {kinds}")
        parts.append(stored(part, "decontaminate-hits"))         # the blocks' tables are never held together
        shipped.unpersist()
        items, later, first = later, next(blocks, None) if later is not None else None, False
    hits = reduce(DataFrame.unionByName, parts).groupBy("at").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("hit_spans")).alias("hit_spans"),
        F.flatten(F.collect_list("hit_items")).alias("hit_items"))
    hits = hits.mapInArrow(merge, f"at bigint, {kinds}")
    return rows.join(hits, "at").select("row.*", *found)
