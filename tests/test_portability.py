"""The entry module works from any working directory (as a driver loads it)."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_queries_run_from_another_directory(tmp_path):
    script = textwrap.dedent(f"""
        import importlib.util
        spec = importlib.util.spec_from_file_location("entry", {os.path.join(ROOT, "__spark_entry__.py")!r})
        E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").getOrCreate()
        assert E.entry(spark).count() > 0
        # a query whose work includes an Arrow UDF: executors must get the code
        n = E.queries()["hashing_tf"](spark, "/root/testdata/sf0.001").count()
        assert n > 0
        print("OK", n)
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env,
                       capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-3000:]
    assert "OK" in r.stdout
