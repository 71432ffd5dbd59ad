"""Answers of a model hook survive the task, and the run, that asked for them."""

import os
import subprocess
import sys
from collections import Counter

import pytest

from cadenza.operators.answers import infer_answers, log_folder

NO_ANSWERS = "answer_key string, listening_context string, contraindications string, rationale string"
TRACKS = "_row long, answer_key string, lyric_valence double, lyric_arousal double"
GOOD = '{"listening_context": "c", "contraindications": "n", "rationale": "r"}'


def ends_once(asked, crash):
    """Notes each key it is asked for; on the 25th call its process ends, once."""
    def model(batches):
        for pdf in batches:
            if len(os.listdir(asked)) >= 25 and not os.path.exists(crash):
                open(crash, "w").close()
                os._exit(1)
            for k in pdf["answer_key"]:
                open(os.path.join(asked, f"{k}-{len(os.listdir(asked))}-{os.getpid()}"), "w").close()
            yield pdf.assign(raw=GOOD)[["answer_key", "raw"]]
    return model


def keys_asked(asked):
    return Counter(f.split("-")[0] for f in os.listdir(asked))


def retried(folder):
    """In a session of its own that retries tasks: one run, a task of which ends half-way."""
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[1,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.checkpoint.dir", os.path.join(folder, "shared")).getOrCreate())
    tracks = s.createDataFrame([(i, f"k{i}", .1, .1) for i in range(60)], TRACKS)
    filled, _, failures = infer_answers(tracks, s.createDataFrame([], NO_ANSWERS), "_row", save_every=1,
                                        model=ends_once(os.path.join(folder, "asked"), os.path.join(folder, "crash")))
    assert filled.where("answer_source = 'model'").count() == 60 and failures.count() == 0
    s.stop()


def test_a_retried_task_asks_only_the_rest(tmp_dir):
    os.mkdir(os.path.join(tmp_dir, "asked"))
    here = os.path.dirname(os.path.abspath(__file__))
    code = f"import sys; sys.path[:0] = [{here!r}, {os.path.dirname(here)!r}]; import test_answer_log as t; t.retried({tmp_dir!r})"
    env = {**os.environ, "PYTHONPATH": os.pathsep.join([here, os.path.dirname(here)])}
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, env=env)
    assert done.returncode == 0, done.stderr[-3000:]
    assert os.path.exists(os.path.join(tmp_dir, "crash"))
    assert keys_asked(os.path.join(tmp_dir, "asked")) == {f"k{i}": 1 for i in range(60)}


def test_a_later_run_takes_over_a_log(spark, tmp_dir):
    calls = spark.sparkContext.accumulator(0)
    seen = spark.sparkContext.accumulator(0)

    def picky(bad):
        def model(batches):
            for pdf in batches:
                calls.add(1)
                seen.add(len(pdf))
                if pdf["answer_key"].isin(bad).any():
                    raise RuntimeError("refused")
                yield pdf.assign(raw=["{" if bad and k == "k9" else GOOD for k in pdf["answer_key"]])[["answer_key", "raw"]]
        return model

    tracks = spark.createDataFrame([(i, f"k{i}", .1, .1) for i in range(40)], TRACKS)
    empty = spark.createDataFrame([], NO_ANSWERS)
    log = os.path.join(tmp_dir, "log")
    run = lambda bad: infer_answers(tracks, empty, "_row", model=picky(bad), log=log, save_every=4, buckets=3)
    _, snap, failures = run(["k7"])
    assert (snap.count(), sorted(r.answer_key for r in failures.collect())) == (38, ["k7", "k9"])
    n = seen.value
    assert n >= 40 and calls.value >= 10
    _, snap, failures = run([])                              # only the keys without an answer are asked again
    assert (snap.count(), failures.count(), seen.value - n) == (40, 0, 2)
    assert not [f for _, _, fs in os.walk(log) for f in fs if f.endswith(".tmp")]


@pytest.mark.parametrize("path,want", [("/a/b", "/a/b"), ("file:/a/b", "/a/b"), ("file:///a/b", "/a/b")])
def test_log_folder(path, want):
    assert log_folder(path)[1] == want
