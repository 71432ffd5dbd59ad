import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cadenza.session import local_session
    s = local_session("*", shuffle_partitions=8, app="cadenza-tests")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Collect selected columns as a list of tuples (order preserved)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]


def one_col(spark, values, ddl):
    return spark.createDataFrame([(v,) for v in values], ddl)
