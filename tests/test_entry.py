"""The driver's contract."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_names_can_be_read_without_a_session():
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q) and len(q) > 60 and all(o.values())"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_entry_runs(spark):
    import __spark_entry__

    if os.path.isdir("/root/testdata/sf0.001"):
        assert __spark_entry__.entry(spark).count() > 0
