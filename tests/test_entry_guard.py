"""The entry module works without the optional parts."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; q = e.queries(); print(set(e.oracle_sql()) <= set(q), *q)"


@pytest.mark.parametrize("without", [["quire/llm"], ["corpus_pipeline.py"], ["quire/llm", "corpus_pipeline.py"]])
def test_queries_of_a_copy_without_the_optional_parts(tmp_path, without):
    copy = tmp_path / "repo"
    left_out = {os.path.join(ROOT, w) for w in without} | {os.path.join(ROOT, d) for d in ("tests", ".git")}
    shutil.copytree(ROOT, copy, ignore=lambda d, names: [n for n in names if os.path.join(d, n) in left_out or n == "__pycache__"])
    run = subprocess.run([sys.executable, "-c", SHOW], cwd=copy, capture_output=True, text=True, timeout=120, env=os.environ | {"PYTHONPATH": str(copy)})
    assert run.returncode == 0, run.stderr
    complete, *names = run.stdout.split()
    assert complete == "True" and "retrieve_top10" in names and "pipeline" not in names
    assert ("quire/llm" in without) == (not [n for n in names if n.startswith("op")])
