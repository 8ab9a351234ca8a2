import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    import tempfile

    from vaultline.session import _DEFAULTS, clear_work, ensure_checkpoint_dir

    b = SparkSession.builder.master("local[*]").appName("vaultline-tests")
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    s = b.config("spark.sql.shuffle.partitions", "8").config(
        "spark.checkpoint.dir", tempfile.mkdtemp(prefix="vaultline-tests-")).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    clear_work(s)


@pytest.fixture()
def tmp(tmp_path):
    """A fresh scratch folder per test."""
    return str(tmp_path)


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally projected)."""
    if cols:
        df = df.select(*cols)
    return sorted(tuple(r) for r in df.collect())
