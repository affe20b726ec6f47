"""The entry points without the training-data folders, as a user may install them."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
ASK = """
import __spark_entry__ as e
names, sqls = set(e.queries()), set(e.oracle_sql())
assert "newest_articles_page" in names and sqls <= names and len(names) > 100
print(sorted(n for n in names if n == "pipeline" or n.startswith("op")))
"""


@pytest.mark.parametrize("without", [("llm",), ("llm", "corpus_pipeline.py")])
def test_queries_without_training_data(tmp_path, without):
    for name in ("broadsheet", "__spark_entry__.py", "corpus_pipeline.py"):
        source = ROOT / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", *without))
        elif source.exists() and name not in without:
            shutil.copy(source, tmp_path / name)
    run = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
    assert run.returncode == 0, run.stderr
    assert run.stdout.strip() == "[]"
