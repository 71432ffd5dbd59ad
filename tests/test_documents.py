"""JSON documents cut into splits at any comma."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from cadenza.sources import documents, io


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def text_of(rnd):
    return "".join(rnd.choice(['a', ',', '"', '\\', '{', '}', '[', ']', ':', '\n', ', "', '\\"', "é漢", "x" * 40, "," * 30, " "])
                   for _ in range(rnd.randint(0, 12)))


@pytest.mark.parametrize("seed", range(4))
def test_splits_anywhere(spark, tmp_dir, small_splits, seed):
    rnd, want = random.Random(seed), {}
    for name in ("1.json", "2.json", "3.json"):
        doc = {f"{name}{k}{text_of(rnd)}": {"BPM": rnd.choice([None, 90.5, 1e3]), "Mode": rnd.choice([None, text_of(rnd), "y" * 900]),
                                            "other": [1, {"deep": [text_of(rnd), []]}]} for k in range(rnd.choice([0, 1, 60]))}
        want |= {k: (v["BPM"], v["Mode"]) for k, v in doc.items()}
        write(tmp_dir, name, rnd.choice(["", "﻿", " \n"]) + json.dumps(doc, indent=rnd.choice([None, 2]), ensure_ascii=rnd.random() < .5) + "\n")
    got = [(r.song_key, (r.BPM, r.Mode)) for r in io.import_cache_document(spark, tmp_dir).collect()]
    assert len(got) == len(want) and dict(got) == want


def test_one_document_is_read_by_many_tasks(spark, tmp_dir, small_splits):
    path = write(tmp_dir, "d.json", json.dumps({f"k{i}": {"BPM": float(i), "Mode": "Major"} for i in range(500)}))
    assert documents._pieces(spark, path).select(F.spark_partition_id().alias("p")).distinct().count() > 4
    assert {r.song_key: r.BPM for r in io.import_cache_document(spark, path).collect()} == {f"k{i}": float(i) for i in range(500)}


@pytest.mark.parametrize("text", ["", "  ", "{not json", '{"a": {"BPM": 1}', '{"a": {"BPM": 1}, }', '[{"a": 1}]', '{"a": {"BPM": 1} "b": {}}', '{"a": 1}{"b": 2, "c": 3}', '{"a": 1}, {"b": 2}', '{"a": 1}} {', '{"a": "open}', "7", '"x, y"'])
def test_what_is_no_object_gives_no_rows(spark, tmp_dir, text):
    write(tmp_dir, "bad.json", text)
    write(tmp_dir, "good.json", '{"g": {"BPM": 2.5}}')
    assert [(r.song_key, r.BPM, r.Mode) for r in io.import_cache_document(spark, tmp_dir).collect()] == [("g", 2.5, None)]


def test_repeated_keys_and_values_that_are_no_object(spark, tmp_dir):
    write(tmp_dir, "a.json", '{"k": {"BPM": 1}, "n": null, "k": {"BPM": 2}, "s": "x", "m": 3, "l": [1, 2]}')
    write(tmp_dir, "b.json", '{"z": {"Mode": "Minor"}, "s": {"BPM": 4}}')
    got = {r.song_key: (r.BPM, r.Mode) for r in io.import_cache_document(spark, tmp_dir).collect()}
    assert got == {"k": (2.0, None), "n": (None, None), "s": (4.0, None), "m": (None, None), "l": (None, None), "z": (None, "Minor")}
