"""Python task code must not need this package on the workers: run the one
operator with Python tasks from another working directory, in a fresh session
whose workers only see the standard library, numpy and pandas."""

import os
import subprocess
import sys
import textwrap

from conftest import ROOT, SF001


def test_top_k_runs_when_workers_cannot_import_the_package(tmp_path):
    script = textwrap.dedent(
        f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        from hourglass.operators.topk import top_k_by_dot
        from hourglass.sources import embedding_factors
        uf, itf = embedding_factors(spark, {SF001!r})
        print("ROWS", top_k_by_dot(uf, itf, 3).count())
        """
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600
    )
    assert "ROWS 300" in out.stdout, out.stderr[-2000:]
