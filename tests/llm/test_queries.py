"""The registered queries as the driver runs them: against SQL, and without the package on the workers."""

import os
import subprocess
import sys

import pytest

import oracle
from presslake.llm.queries import ORACLES, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    got, want = oracle.actual(QUERIES[name](spark, SF_DIR)), oracle.expected(oracle.connect(SF_DIR), ORACLES[name])
    assert got == want and got[1]


def test_workers_need_no_installed_package(tmp_path):
    """All operators, started in a folder from which the workers cannot import the package."""
    script = f"""
import sys; sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
for name, fn in entry.queries().items():
    if name.startswith("op") or name == "pipeline":
        print(name, fn(spark, {SF_DIR!r}).count(), flush=True)
"""
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=900)
    names = [line.split()[0] for line in done.stdout.splitlines()]
    assert set(names) == {*QUERIES, "pipeline"}, done.stderr[-3000:]
