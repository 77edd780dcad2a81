"""Every registered query against its SQL twin on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog.registry import QUERIES
from tests.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, connection, name):
    df = queries()[name](spark, SF_DIR)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, connection, sql) == ""


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["id", "timestamp", "text", "n_tokens", "truncated"]
    assert df.count() > 0


def test_sql_needs_no_spark_folder(tmp_path):
    """The twins are built in a process whose Spark has neither jars nor a session."""
    code = f"import pyspark; pyspark.__file__ = {str(tmp_path / '__init__.py')!r}; import __spark_entry__ as e; print(len(e.oracle_sql()))"
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, "-W", "error::UserWarning", "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout.split()[-1]) == len(oracle_sql())
