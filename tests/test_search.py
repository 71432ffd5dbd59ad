"""Free search against a brute-force loop over all searches and entries."""

import random
import re

import pytest
from pyspark.sql import functions as F

from cadenza.operators.search import search_tracks

CATALOG = ("id string, external_urls struct<spotify: string>, name string, "
           "artists array<struct<name: string>>, rank int")
SONGS = "n int, title string, artist string"


def words(*parts):
    return set(re.findall(r"[^\W_]+", " ".join(p for p in parts if p is not None).lower()))


def brute(songs, catalog):
    hits, missing = {}, {}
    for n, title, artist in songs:
        t, a = (title or "").strip(), (artist or "").strip()
        if not t or not a:
            continue
        want = words(t, a)
        found = [c for c in catalog if want and want <= words(c[2], *[x[0] for x in c[3] or []])]
        if found:
            best = min(found, key=lambda c: c[4])
            hits[n] = (best[0], best[1][0], best[2])
        else:
            missing[n] = f"{t} {a}"
    return hits, missing


def run(spark, songs, catalog, block_rows):
    h, m = search_tracks(spark.createDataFrame(songs, SONGS), spark.createDataFrame(catalog, CATALOG),
                         [F.col("rank")], block_rows=block_rows)
    hits = {r["n"]: (r["track_id"], r["source_link"], r["found_title"]) for r in h.collect()}
    return hits, {r["n"]: r["search"] for r in m.collect()}


@pytest.mark.parametrize("block_rows", [2, 4096])
def test_equals_brute_force_with_a_word_in_every_entry(spark, block_rows):
    rng = random.Random(5)
    vocabulary = ["love", "night", "été", "blue", "train", "rain", "sun", "road", "Zoë", "7"]
    catalog = [(f"t{i}", (f"u{i}",), "the " + " ".join(rng.choices(vocabulary, k=rng.randint(1, 4))),
                [(rng.choice(vocabulary),), ("band",)], 1000 - i) for i in range(120)]
    songs = [(i, " ".join(rng.choices([*vocabulary, "the", "nowhere"], weights=[3] * 10 + [6, 1], k=rng.randint(1, 3))),
              rng.choice(["band", "The Band!", *vocabulary])) for i in range(150)]
    assert run(spark, songs, catalog, block_rows) == brute(songs, catalog)


def test_edges(spark):
    catalog = [("a", ("u",), "Hey, you (live)", [("Ann",), ("Bob",)], 2), ("b", None, "hey you", [("ann",)], 1),
               ("c", ("w",), None, None, 0), ("d", ("x",), "solo", [], 3)]
    songs = [(1, "HEY YOU", "ann"), (2, " hey ", "bob"), (3, None, "ann"), (4, "hey", "  "), (5, "!!", "??"),
             (6, "you you you", "ann"), (7, "hey you", "ann"), (8, "unheard", "ann"), (9, "solo", "solo")]
    want = ({1: ("b", None, "hey you"), 2: ("a", "u", "Hey, you (live)"), 6: ("b", None, "hey you"),
             7: ("b", None, "hey you"), 9: ("d", "x", "solo")}, {5: "!! ??", 8: "unheard ann"})
    assert run(spark, songs, catalog, 1) == want


def test_empty_tables(spark):
    assert run(spark, [], [("a", ("u",), "x", [("y",)], 1)], 4) == ({}, {})
    assert run(spark, [(1, "x", "y")], [], 4) == ({}, {1: "x y"})
