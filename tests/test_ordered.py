"""File order over several files, and CSV files cut into splits inside quoted fields."""

import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from cadenza.sources import io, ordered


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def write(folder, name, text):
    with open(os.path.join(folder, name), "w", newline="") as f:
        f.write(text)


def test_rows_follow_paths_not_sizes(spark, tmp_dir):
    for name, n in (("a.csv", 3), ("b.csv", 4000), ("c.csv", 10), ("d.csv", 900)):
        write(tmp_dir, name, "k,v\n" + "".join(f"{name[0]},{i}\n" for i in range(n)))
    want = [(c, i) for c, n in zip("abcd", (3, 4000, 10, 900)) for i in range(n)]
    for multi in (False, True):
        got = io.read_csv(spark, tmp_dir, "k string, v int", multi_line=multi).collect()
        assert sorted((r._row, r.k, r.v) for r in got) == [(k, *x) for k, x in enumerate(want)]


def test_last_file_wins(spark, tmp_dir):
    write(tmp_dir, "a.txt", "joy 0.1 1\n")
    write(tmp_dir, "b.txt", "joy 0.2 2\n" + "".join(f"w{i} 0.5 0.5\n" for i in range(3000)))
    write(tmp_dir, "c.txt", "Joy 0.3 3\n")
    got = {r.word: r.valence for r in io.read_lexicon(spark, tmp_dir).collect()}
    assert got["joy"] == 0.3 and len(got) == 3001


def test_listed_lines_over_files(spark, tmp_dir):
    write(tmp_dir, "a.txt", "\n \nx\n")
    write(tmp_dir, "b.txt", "y\n\n" * 500)
    write(tmp_dir, "c.txt", "\n\nz\n\n  \n")
    assert io.count_listed_lines(spark, tmp_dir).first().n_lines == 1 + 1000 + 3


def random_field(rnd):
    return rnd.choice(["", "plain", "two words", 'say "hi"', "a,b", "line\nbreak", "cr\r\nlf", '"', '""', "\n\n\n", "x" * 300,
                       "long " * 60 + "\n" + 'q"' * 40, "é漢\n字", " lead", "NA"])


@pytest.mark.parametrize("seed", range(4))
def test_splits_inside_fields(spark, tmp_dir, small_splits, seed):
    rnd, want = random.Random(seed), []
    for name in ("1.csv", "2.csv", "3.csv", "4.csv"):
        rows = [(i, random_field(rnd), random_field(rnd)) for i in range(rnd.choice([0, 1, 40, 150]))]
        want += rows
        with open(os.path.join(tmp_dir, name), "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f, lineterminator=rnd.choice(["\n", "\r\n"]), quoting=rnd.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
            out.writerow(["id", "a", "b"])
            out.writerows(rows)
    df = io.read_csv(spark, tmp_dir, "id int, a string, b string")
    assert sorted(tuple(r) for r in df.select("_row", "id", "a", "b").collect()) == [
        (k, i, a or None, b or None) for k, (i, a, b) in enumerate(want)]


def test_a_field_longer_than_many_splits(spark, tmp_dir, small_splits):
    text = "\n".join(f'line {i} "quoted"' for i in range(500))
    with open(os.path.join(tmp_dir, "a.csv"), "w", newline="") as f:
        out = csv.writer(f, lineterminator="\n")
        out.writerows([["id", "t"], [1, "a"], [2, text], [3, "b"], [4, text], [5, text]])
    df = io.read_csv(spark, tmp_dir, "id int, t string")
    assert ordered._lines(spark, tmp_dir).rdd.getNumPartitions() > 8            # one file, many tasks
    assert [(r._row, r.id, r.t) for r in df.orderBy("_row").collect()] == [(0, 1, "a"), (1, 2, text), (2, 3, "b"), (3, 4, text), (4, 5, text)]


def test_odd_files(spark, tmp_dir):
    write(tmp_dir, "a.csv", "")
    write(tmp_dir, "b.csv", "id,t\n")
    write(tmp_dir, "c.csv", "id,t\n\n1,x\n\n\n2,\"open\nto the end\n")
    write(tmp_dir, "d.csv", "id,t\n3,z")
    got = [(r._row, r.id, r.t) for r in io.read_csv(spark, tmp_dir, "id int, t string").orderBy("_row").collect()]
    assert [g[:2] for g in got] == [(0, 1), (1, 2), (2, 3)] and got[0][2] == "x" and got[1][2].startswith("open\nto the end") and got[2][2] == "z"


def test_reading_equals_sparks_own_multiline(spark, tmp_dir):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", F.concat(F.lit('say "hi",\n'), "text").alias("text"), "lang")
    io.write_csv(df, tmp_dir + "/out")
    own = spark.read.schema("doc_id bigint, text string, lang string").options(**io.CSV_OPTIONS, multiLine="true").csv(tmp_dir + "/out")
    got = io.read_csv(spark, tmp_dir + "/out", "doc_id bigint, text string, lang string", row_col=None)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, own.collect()))
