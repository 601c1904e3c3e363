"""The package works from any working directory and on workers that do not have it."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as entry
print("ROWS", entry.queries()["spectral_centroid"](spark, {root!r}).count())
"""


def test_python_workers_get_the_package(tmp_path, root):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(repo=repo, root=root))
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_ENV_LOADED")}
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True,
        timeout=300,
    )
    assert "ROWS 3500" in done.stdout, done.stderr[-2000:]
