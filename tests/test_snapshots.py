"""Snapshots written at one time by several writers."""

import threading

from cadenza.sources import io


def test_writers_at_one_time_lose_no_snapshot(spark, tmp_dir):
    base, paths, errors = tmp_dir + "/cache", [], []
    io.write_snapshot(spark.createDataFrame([(0, 0)], "writer int, k int"), base)

    def work(writer):
        try:
            for k in range(3):
                paths.append(io.write_snapshot(spark.createDataFrame([(writer, k)], "writer int, k int"), base))
        except Exception as e:          # noqa: BLE001  shown below
            errors.append(e)

    threads = [threading.Thread(target=work, args=(w,)) for w in (1, 2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and len(set(paths)) == 6
    versions = io.snapshot_versions(spark, base)
    assert versions == list(range(1, 8))
    seen = {tuple(spark.read.parquet(f"{base}/v={v}").first()) for v in versions}
    assert seen == {(0, 0)} | {(w, k) for w in (1, 2) for k in range(3)}
    assert io.read_snapshot(spark, base).count() == 1


def test_a_claimed_number_without_a_folder_is_skipped(spark, tmp_dir):
    """A writer that dies between its claim and the rename leaves no version behind."""
    import os
    base = tmp_dir + "/cache"
    df = spark.createDataFrame([(1,)], "k int")
    assert io.write_snapshot(df, base).endswith("v=1")
    open(os.path.join(base, "_claim-2"), "w").close()
    assert io.write_snapshot(df, base).endswith("v=3")
    assert io.snapshot_versions(spark, base) == [1, 3]
    assert io.write_snapshot(df, base, version=9).endswith("v=9") and io.snapshot_versions(spark, base) == [1, 3, 9]
