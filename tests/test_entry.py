"""The entry module, with and without the parts that may be absent."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_without_the_llm_parts(tmp_path):
    target = tmp_path / "repo"
    shutil.copytree(ROOT, target, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "tests"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'resume_schedule' in q and 'pipeline' not in q and not any(k.startswith('op') for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=target, check=True, timeout=120)


def test_nothing_outside_llm_imports_it():
    for path in (ROOT / "clipwright").rglob("*.py"):
        if "llm" not in path.parts:
            assert "clipwright.llm" not in path.read_text(), path


JOB = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})  # the driver's path alone
from clipwright.queries import QUERIES
from clipwright.session import build_session

spark = build_session("local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="2g")
for name in ("predicted_masks", "track_ids", "mask_rle", "frame_source", "clip_run", "file_checksums"):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0, name
    print(name, flush=True)
"""


def test_python_queries_where_workers_lack_the_package(tmp_path):
    (tmp_path / "job.py").write_text(JOB)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "job.py"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert ran.returncode == 0 and len(ran.stdout.split()) == 6, ran.stdout + ran.stderr[-3000:]
