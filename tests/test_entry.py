"""The entry module with and without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__

ROOT = Path(__file__).resolve().parents[1]


def test_entry_and_names(spark):
    assert __spark_entry__.entry(spark).columns
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("gone", [("llm",), ("llm", "corpus_pipeline.py")])
def test_rest_imports_without_llm(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", *gone))
    code = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), any(n.startswith('op') and n[2].isdigit() for n in e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    n, pipeline, ops, sql = out.stdout.split()
    assert int(n) == int(sql) > 90 and pipeline == "False" and ops == "False", out.stderr
