"""A new session after stop() reuses the written layers of the same shared folder."""

import os
import subprocess
import sys
import tempfile
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_queries_survive_a_session_restart():
    ck = tempfile.mkdtemp(prefix="riskmart-restart-")
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession
        import __spark_entry__ as e

        def session():
            s = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.checkpoint.dir", {ck!r}).getOrCreate())
            s.sparkContext.setLogLevel("ERROR")
            return s

        q = e.queries()
        s1 = session()
        a = q["fraud_rate_by_hour"](s1, "/root/testdata/sf0.001").count()
        s1.stop()
        s2 = session()
        b = q["fraud_rate_by_hour"](s2, "/root/testdata/sf0.001").count()
        print("RESULT", a, b)
    """)
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True,
                         timeout=600)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("RESULT")]
    assert line, out.stderr[-2000:]
    _, a, b = line[0].split()
    assert a == b and int(a) > 0
