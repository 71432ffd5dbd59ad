"""Conversation prefix trie, rolled up by centroid decomposition.

A node stands for a sequence of first turns that conversations share.  It is named by its depth and
the sum of t_j * BASE^j modulo a prime of 127 bits over its turns, t_j being the truncated SHA-256 of
role and text.  Such sums add up piece by piece, so a conversation may lie in many tasks: the turns
are sorted over all tasks, each task numbers and sums its own, and what stands in the tasks before is
added from two marks a task.  Texts are never shuffled.

``tree_totals`` sums values over subtrees.  A component of the parent-edge forest has its size (rows of
conversations) at its top; the nodes whose size is over half of that are the path from the top to the
centroid.  What the centroid's subtree adds up to goes to the whole path, its size is taken off, and the
component falls into the centroid's children's parts and the part above, each of half the size at most.
So rounds are as many as the size has binary digits, however long or broad the tree is.
Which child's part a node belongs to is looked up once for each component and smallest member, on that
member's path.  Components of at most ``SMALL`` rows are finished inside tasks by the same steps.

NULL roles and texts are empty; rows without conv_id belong to no conversation and are left out; turns
with equal numbers stand in the order of the hash of role and text; repeated rows are turns of their own;
an empty table has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.common import lookup_join
from .base import rows_of, stored, text_of

PRIME = (1 << 127) - 1
BASE = 0x5851F42D4C957F2D14057B7EF767814F          # fixed, below PRIME
SMALL = 1 << 14        # rows of a component that one task finishes
BLOCK = 20             # conversations that begin like the first of their block ...
SHARED = 4             # ... with fewer than so many turns
CHUNK = 4096           # members of a node whose numbers are joined at a time

_WORDS = r"[^\x20\x09-\x0D]+"


def _power(n: int) -> int:
    return pow(BASE, n, PRIME)


def _name(depth: int, value: int) -> bytes:
    return struct.pack(">I", depth) + value.to_bytes(16, "big")


ROOT = _name(0, 0)


# --- conversations -------------------------------------------------------------------------

def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, place, t, words, total): each turn's number in its conversation from 0, its hash, the words
    of its text, and the sum over the turns up to it."""
    role = text_of("role")
    mark = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text_of("text")).cast("binary")
    slim = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.unhex(F.substring(F.sha2(mark, 256), 1, 32)).alias("t"),
        F.regexp_count(text_of("text"), F.lit(_WORDS)).cast("bigint").alias("words"), F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", "turn", "t", "row"]

    def scan(batches):
        from pyspark import TaskContext
        part, conv, n, total, power, first = TaskContext.get().partitionId(), None, 0, 0, 1, True
        names = ["part", "conv_id", "place", "t", "words", "total", "mark"]

        def made(rows):
            cols = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        for b in batches:
            out = []
            for c, t, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if c != conv:
                    if first and conv is not None:          # the end of the task's first conversation
                        out.append((part, conv, n, None, None, total.to_bytes(16, "big"), 1))
                        first = False
                    conv, n, total, power = c, 0, 0, 1
                total = (total + int.from_bytes(t, "big") % PRIME * power) % PRIME
                out.append((part, c, n, t, w, total.to_bytes(16, "big"), 0))
                n, power = n + 1, power * BASE % PRIME
            yield made(out)
        if conv is not None:
            yield made([(part, conv, n, None, None, total.to_bytes(16, "big"), 1)])

    kind = "part int, conv_id bigint, place bigint, t binary, words bigint, total binary, mark int"
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    local = stored(slim.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                   .select("conv_id", "t", "words").mapInArrow(scan, kind), "trie-turns")
    before, held = {}, {}
    for r in local.where("mark = 1").select("part", "conv_id", "place", "total").orderBy("part", "conv_id").collect():   # two a task
        n, total = held.get(r["conv_id"], (0, 0))
        if n:
            before[r["part"], r["conv_id"]] = n, total
        held = {r["conv_id"]: (n + r["place"], (total + int.from_bytes(r["total"], "big") * _power(n)) % PRIME)}

    def shift(batches):
        powers = {k: _power(n) for k, (n, _) in before.items()}
        for b in batches:
            rows = rows_of(b)
            places, totals = rows["place"], rows["total"]
            for k, key in enumerate(zip(rows["part"], rows["conv_id"])):
                if key in before:
                    n, total = before[key]
                    places[k] += n
                    totals[k] = ((total + int.from_bytes(totals[k], "big") * powers[key]) % PRIME).to_bytes(16, "big")
            yield pa.RecordBatch.from_arrays(
                [b.column(1), pa.array(places, pa.int64()), b.column(3), b.column(4), pa.array(totals, pa.binary())],
                names=["conv_id", "place", "t", "words", "total"])

    turns_only = local.where("mark = 0").drop("mark")
    if not before:
        return turns_only.drop("part")
    return turns_only.mapInArrow(shift, "conv_id bigint, place bigint, t binary, words bigint, total binary")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, length, node, parent, words) of the prefixes of each rebuilt conversation, the empty
    one included; ``length`` is that of the whole conversation, ``words`` those of the prefix's last text.

    Conversation c is rebuilt from the first h turns of the first one of its block, c - c % BLOCK, and its own
    without its first h, where h = crc32(c in decimal) % SHARED."""
    rows = stored(numbered(turns), "trie-numbered")
    few = SHARED - 1
    at = lambda k, c: F.max(F.when(F.col("place") == k, F.col(c)))
    heads = rows.where(F.col("place") < few).groupBy("conv_id").agg(
        *(at(k, "t").alias(f"t{k}") for k in range(few)), *(at(k, "words").alias(f"w{k}") for k in range(few)))
    heads = heads.select("conv_id", F.filter(F.array(*(F.struct(F.col(f"t{k}").alias("t"), F.col(f"w{k}").alias("words"))
                                                       for k in range(few))), lambda x: x["t"].isNotNull()).alias("head"))
    counts = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(SHARED)).cast("int")
    base = heads.select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"))
    starts = (heads.join(counts, "conv_id").withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % BLOCK)
              .join(base, "base", "left")
              .select("conv_id", "h", F.slice("head", F.lit(1), F.col("h")).alias("own"), "n",
                      F.slice(F.coalesce("base_head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h")).alias("given")))
    length = F.size("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    starts = stored(starts.select("conv_id", "h", "own", "given", length.cast("bigint").alias("length")), "trie-starts")

    def total(turns_: list) -> int:
        return sum(int.from_bytes(x["t"], "big") % PRIME * _power(k) for k, x in enumerate(turns_)) % PRIME

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
    names = ["conv_id", "depth", "length", "node", "parent", "words"]
    made = lambda rows_: pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(list(zip(*rows_)) or [()] * 6, kinds)], names=names)

    def first(batches):
        for b in batches:
            out = []
            for c, given, n in zip(*(rows_of(b)[x] for x in ("conv_id", "given", "length"))):
                out.append((c, 0, n, ROOT, None, 0))
                for d in range(1, len(given) + 1):
                    out.append((c, d, n, _name(d, total(given[:d])), _name(d - 1, total(given[:d - 1])), given[d - 1]["words"]))
            yield made(out)

    def rest(batches):
        back = pow(BASE, -1, PRIME)
        conv = start = None
        for b in batches:
            out = []
            r = rows_of(b)
            for k, c in enumerate(r["conv_id"]):
                if c != conv:
                    own, given, h = r["own"][k], r["given"][k], r["h"][k]
                    less = h - len(given)                   # the conversation is so much shorter
                    conv, start = c, (total(given), total(own), less, pow(back, less, PRIME))
                given_total, own_total, less, factor = start
                place = r["place"][k] - less                # in the rebuilt conversation
                value = (given_total + (int.from_bytes(r["total"][k], "big") - own_total) * factor) % PRIME
                above = (value - int.from_bytes(r["t"][k], "big") % PRIME * _place_power(place)) % PRIME
                out.append((c, place + 1, r["length"][k], _name(place + 1, value), _name(place, above), r["words"][k]))
            yield made(out)

    kind = "conv_id bigint, depth bigint, length bigint, node binary, parent binary, words bigint"
    joined = lookup_join(rows, starts, ["conv_id"], "inner").where("place >= h")
    return (starts.select("conv_id", "given", "length").mapInArrow(first, kind)
            .unionByName(joined.select("conv_id", "place", "t", "words", "total", "h", "own", "given", "length").mapInArrow(rest, kind)))


_POWERS: list[int] = [1]


def _place_power(n: int) -> int:
    if n >= 1 << 16:
        return _power(n)
    while len(_POWERS) <= n:
        _POWERS.append(_POWERS[-1] * BASE % PRIME)
    return _POWERS[n]


# --- rollup --------------------------------------------------------------------------------

def _solve(rows: list[dict], values: list[str]) -> list[tuple]:
    """(node, sums) of one component, whose rows are sorted by depth; decomposed at its centroids."""
    number = {r["node"]: k for k, r in enumerate(rows)}
    children: list[list[int]] = [[] for _ in rows]
    for k, r in enumerate(rows):
        if k and r["parent"] in number:
            children[number[r["parent"]]].append(k)
    size = [r["size"] for r in rows]
    own = [[r[v] for v in values] for r in rows]
    sums = [[r[f"sum_{v}"] for v in values] for r in rows]
    cut = [False] * len(rows)
    tops = [0] if rows else []
    while tops:
        path = [tops.pop()]
        half = size[path[0]] / 2
        while (heavy := next((k for k in children[path[-1]] if not cut[k] and size[k] > half), None)) is not None:
            path.append(heavy)
        c = path[-1]
        total, todo = [0] * len(values), [c]
        while todo:
            k = todo.pop()
            total = [a + b for a, b in zip(total, own[k])]
            todo += [x for x in children[k] if not cut[x]]
        for k in path:
            sums[k] = [a + b for a, b in zip(sums[k], total)]
            if k != c:
                size[k] -= size[c]
        tops += [x for x in children[c] if not cut[x]]
        cut[c] = True
        if len(path) > 1:
            tops.append(path[0])
    return [(r["node"], *sums[k]) for k, r in enumerate(rows)]


def tree_totals(nodes: DataFrame, paths: DataFrame, values: list[str], small: int = SMALL) -> DataFrame:
    """(node, each of ``values`` summed over the node's subtree) for a tree.

    ``nodes``: node, parent (NULL at the top), depth, conv_id (a conversation through it that stays the same
    down to that one's end), size (rows of ``paths`` in its subtree) and the values, bigint; ``paths``:
    (conv_id, depth, node, parent) of whole conversations."""
    spark = nodes.sparkSession
    both = [*values, *(f"sum_{v}" for v in values)]
    kept = ["node", "parent", "depth", "conv_id", "size", *both]
    top = nodes.where("parent is null").select(F.col("node").alias("part"), F.col("size").alias("whole"))
    left = stored(nodes.select("node", "parent", "depth", "conv_id", "size", *values, *(F.lit(0).cast("bigint").alias(f"sum_{v}") for v in values))
                  .crossJoin(F.broadcast(top)), "trie-rest")           # one row at most: a tree has one top
    schema = "node binary, " + ", ".join(f"{v} bigint" for v in values)

    def solve(batches):
        held, part = [], None
        for b in batches:
            rows = b.to_pylist()
            out = []
            for key, some in groupby(rows, key=lambda r: r["part"]):
                if key != part:
                    out += _solve(held, values)
                    held, part = [], key
                held += some
            yield _sums(out)
        yield _sums(_solve(held, values))

    def _sums(rows):
        cols = list(zip(*rows)) if rows else [()] * (1 + len(values))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), *(pa.array(c, pa.int64()) for c in cols[1:])],
                                          names=["node", *values])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    done = []
    while True:
        done.append(left.where(F.col("whole") <= small).repartition(parts, "part").sortWithinPartitions("part", "depth")
                    .mapInArrow(solve, schema))
        left = left.where(F.col("whole") > small)
        on_path = F.col("size") * 2 > F.col("whole")
        centre = left.where(on_path).groupBy("part").agg(F.max_by(F.struct("node", "depth", "size"), "depth").alias("c"))
        centre = stored(centre.select("part", F.col("c.node").alias("centre"), F.col("c.depth").alias("centre_depth"),
                                      F.col("c.size").alias("centre_size")), "trie-centroids")
        if centre.isEmpty():
            break
        # the child of the centroid through which a conversation goes on
        asked = left.select("part", "conv_id").distinct().join(centre, "part")
        below = (asked.join(paths.select("conv_id", (F.col("depth") - 1).alias("centre_depth"), F.col("node").alias("child"),
                                         F.col("parent").alias("centre")), ["conv_id", "centre_depth", "centre"])
                 .select("part", "conv_id", "child"))
        moved = lookup_join(lookup_join(left, centre, ["part"]), below, ["part", "conv_id"])
        child = F.when(F.col("depth") > F.col("centre_depth"), F.col("child"))
        moved = stored(moved.withColumn("child", child), "trie-moved")
        inside = F.col("child").isNotNull() | (F.col("node") == F.col("centre"))
        totals = moved.where(inside).groupBy("part").agg(*(F.sum(v).alias(f"add_{v}") for v in values))
        sizes = moved.where("child is not null").groupBy("child").agg(F.max("size").alias("child_size"))
        moved = lookup_join(lookup_join(moved, totals, ["part"]), sizes, ["child"])
        for v in values:
            moved = moved.withColumn(f"sum_{v}", F.col(f"sum_{v}") + F.when(on_path, F.col(f"add_{v}")).otherwise(0))
        is_centre = F.col("node") == F.col("centre")
        moved = stored(moved.select(
            "node", "parent", "depth", "conv_id", (F.col("size") - F.when(on_path & ~is_centre, F.col("centre_size")).otherwise(0)).alias("size"),
            *both, F.coalesce("child", "part").alias("part"),
            F.coalesce("child_size", F.col("whole") - F.col("centre_size")).alias("whole"), is_centre.alias("is_centre")), "trie-rest")
        done.append(moved.where("is_centre").select("node", *(F.col(f"sum_{v}").alias(v) for v in values)))
        left = moved.where("not is_centre").select(*kept, "part", "whole")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


# --- the trie ------------------------------------------------------------------------------

def _digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id): numbers in decimal, ascending, joined by commas.  Runs of numbers
    are joined all over the cluster; only the hash itself goes through them one by one."""
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def chunks(batches):
        for b in batches:
            rows = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            out = []
            for node, some in groupby(rows, key=lambda r: r[0]):
                ids = [i for _, i in some]
                out += [(node, ids[k], ",".join(map(str, ids[k:k + CHUNK]))) for k in range(0, len(ids), CHUNK)]
            nodes, first, shown = zip(*out) if out else ((),) * 3
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(first, pa.int64()), pa.array(shown, pa.string())],
                                             names=["node", "first", "shown"])

    def digest(batches):
        node = state = None
        for b in batches:
            out = []
            for n, shown in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if n != node:
                    if node is not None:
                        out.append((node, state.hexdigest()))
                    node, state = n, hashlib.sha256(shown.encode())
                else:
                    state.update(b"," + shown.encode())
            yield done(out)
        if node is not None:
            yield done([(node, state.hexdigest())])

    def done(rows):
        nodes, shown = zip(*rows) if rows else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(shown, pa.string())], names=["node", "ends_sha256"])

    runs = (ends.repartitionByRange(parts, "node", "conv_id").sortWithinPartitions("node", "conv_id")
            .mapInArrow(chunks, "node binary, first bigint, shown string"))
    return (runs.repartition(parts, "node").sortWithinPartitions("node", "first").select("node", "shown")
            .mapInArrow(digest, "node binary, ends_sha256 string"))


def prefix_trie(turns: DataFrame, small: int = SMALL) -> DataFrame:
    """(node, parent, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of
    each node of the rebuilt conversations of ``turns`` (conv_id, turn, role, text)."""
    rows = stored(prefixes(turns), "trie-prefixes")
    whole: Column = F.col("length") - F.col("depth") + 1
    nodes = rows.groupBy("node", "parent", "depth", "words").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum(whole).alias("size"))
    nodes = stored(nodes, "trie-nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))), "trie-tree")
    sums = tree_totals(nodes.select("node", "parent", "depth", "conv_id", "size", (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
                                    ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")),
                       rows, ["n_leaves", "saved_tokens"], small)
    ends = _digests(rows.where("depth = length").select("node", "conv_id"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.select("node", "parent", "conv_id", "depth", "n_convs", "n_children").join(sums, "node").join(ends, "node", "left")
    return lookup_join(out, parents, ["parent"]).select(
        "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
