"""Small helpers: SRC-4 rename, SRC-9 schema report, SNK-1 CSV sink,
PRJ-15/ORD-2 restore order, key joins, global row number."""

import os

from pyspark.sql import functions as F

from cadenza.operators.common import (ensure_columns, lookup_join, materialised, one_per_key, rename_if_absent,
                                      require_columns, schema_report)
from cadenza.operators.merge import preview, restore_order
from cadenza.operators.rank import global_row_number
from cadenza.sources import io


def test_rename_and_require(spark):
    df = spark.createDataFrame([(1, "x")], "id int, `Source link` string")
    out = rename_if_absent(df, "Source link", "Source Link")
    assert "Source Link" in out.columns and "Source link" not in out.columns
    both = spark.createDataFrame([(1, "x", "y")], "id int, a string, b string")
    assert rename_if_absent(both, "a", "b").columns == ["id", "a", "b"]
    try:
        require_columns(df, ["id", "Title"])
        raise AssertionError("expected a failure")
    except ValueError as e:
        assert "Title" in str(e)
    typed = ensure_columns(df, {"bpm": ("double", None)})
    assert dict(typed.dtypes)["bpm"] == "double"


def test_schema_report(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, name string")
    got = [tuple(r) for r in schema_report(df, "t").collect()]
    assert got == [("t", 0, "id", "int", 2), ("t", 1, "name", "string", 1)]


def test_csv_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(1, 'say "hi"\nthere'), (2, None)], "id int, text string")
    out = os.path.join(tmp_dir, "csv")
    io.write_csv(df, out)
    back = io.read_csv(spark, out, "id int, text string", row_col=None)
    assert sorted(tuple(r) for r in back.collect()) == [(1, 'say "hi"\nthere'), (2, None)]


def test_restore_order_and_preview(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "_row long, v string")
    assert [r.v for r in restore_order(df).collect()] == ["a", "b", "c"]
    assert [r.v for r in preview(df, 2).collect()] == ["a", "b"]


def test_global_row_number_many_partitions(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k"))
    ranked = global_row_number(df, [F.col("k").desc()], "rank", num_partitions=7)
    got = sorted((r.rank, r.k) for r in ranked.collect())
    assert got == [(i + 1, 999 - i) for i in range(1000)]


def test_lookup_join_equals_a_plain_join(spark):
    rows = [(None if k % 10 else k % 3, k, None) for k in range(1000)] + [(0, -k, "x") for k in range(300)]
    df = spark.createDataFrame(rows, "k int, id int, note string")       # 90 % NULL keys, then one hot key
    right = spark.createDataFrame([(0, "zero"), (1, "one"), (None, "never"), (7, "none")], "k int, name string")
    for how in ("left", "inner", "left_semi", "left_anti"):
        got, want = lookup_join(df, right, ["k"], how), df.join(right, ["k"], how)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), how


def test_lookup_join_spreads_rows_without_a_key(spark):
    df = spark.range(0, 20000).select(F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"), "id")
    right = spark.range(0, 50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    old = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = (lookup_join(df, right, ["k"]).groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[1])
    n = sorted(r["count"] for r in sizes)
    assert len(n) == 8 and n[-1] < 2 * 20000 / 8


def test_no_plan_counts_rows_behind_a_limit(spark):
    plan = lookup_join(spark.range(10).withColumnRenamed("id", "k"), spark.range(5).withColumnRenamed("id", "k"), ["k"])
    assert "Limit" not in plan._jdf.queryExecution().executedPlan().toString()


def test_one_per_key(spark):
    rows = [("a", 3, "x"), ("a", 1, "y"), (None, 5, "n"), (None, 2, "m"), ("b", 4, None)]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    assert sorted(map(tuple, one_per_key(df, ["k"], "o").collect()), key=str) == sorted([("a", 1, "y"), (None, 2, "m"), ("b", 4, None)], key=str)
    assert {r.v for r in one_per_key(df, ["k"], "o", last=True).collect()} == {"x", "n", None}
    plan = one_per_key(df, ["k"], "o")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_materialised_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = materialised(spark.range(100).mapInArrow(count, "id long"), "test")
    assert df.count() == df.distinct().count() == 100 and seen.value == 100
