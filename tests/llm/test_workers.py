"""Every registered query where the workers have no copy of the package."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]
CODE = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})  # the driver's path alone
from clipwright.llm.queries import QUERIES
from clipwright.session import build_session
import corpus_pipeline

spark = build_session("local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="3g")

def absent(_):
    try:
        import clipwright
    except ModuleNotFoundError:
        yield True

assert spark.sparkContext.parallelize([0], 1).mapPartitions(absent).collect() == [True]
for name, query in {{**QUERIES, "pipeline": corpus_pipeline.run}}.items():
    assert query(spark, "/root/testdata/sf0.001").count() > 0, name
    print(name, flush=True)
"""


def test_queries_where_workers_lack_the_package(tmp_path):
    (tmp_path / "job.py").write_text(CODE)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "job.py"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert ran.returncode == 0 and len(ran.stdout.split()) == 11, ran.stdout + ran.stderr[-3000:]
