"""Without the training-data operators the entry, the other queries and their tests still work."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

HOME = Path(__file__).resolve().parent.parent
CODE = """
import __spark_entry__ as e
queries, oracles = e.queries(), e.oracle_sql()
assert queries and set(oracles) <= set(queries), len(queries)
assert not [n for n in queries if n.startswith("op") and n[2].isdigit()] and "pipeline" not in queries
assert "global_change_order" in queries
"""


@pytest.mark.parametrize("pipeline_too", [True, False])
@pytest.mark.parametrize("leftover", [True, False])
def test_entry_without_the_operators(tmp_path, pipeline_too, leftover):
    copy = tmp_path / "repo"
    shutil.copytree(HOME, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm"))
    if leftover:  # a folder that only holds compiled files
        (copy / "changeloom/llm/__pycache__").mkdir(parents=True)
    if pipeline_too:
        (copy / "corpus_pipeline.py").unlink()
    done = subprocess.run([sys.executable, "-c", CODE], cwd=copy, capture_output=True, text=True, timeout=120, check=False)
    assert done.returncode == 0, done.stderr
    done = subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "--ignore", "tests/test_isolation.py"], cwd=copy, capture_output=True, text=True, timeout=120, check=False)
    assert done.returncode == 0, done.stdout
