"""Scale smoke: the same plans at sf0.1 have no Python node
outside the declared hooks, and nothing gathers raw rows into one partition
(a SinglePartition exchange may only feed a global aggregate of partial
results, the rank-offset table or the table of a file's parts, all bounded)."""

import pytest

import __spark_entry__ as entry_mod

SF = "/root/testdata/sf0.1"
SKIP = ("incremental_enrich", "op", "pipeline")
PY_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
            "FlatMapCoGroupsInPandas")


@pytest.mark.parametrize("name", sorted(n for n in entry_mod.queries() if not n.startswith(SKIP)))
def test_plan_shape_at_scale(spark, name):
    df = entry_mod.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(p in plan for p in PY_NODES), name
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = " ".join(lines[i + 1:i + 3])
            assert ("partial_" in below or "_rk_pid" in below or "HashAggregate(keys=[]" in below
                    or "HashAggregate(keys=[part#" in below or "TakeOrderedAndProject" in below), \
                (name, lines[i:i + 3])
