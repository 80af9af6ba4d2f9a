"""The library without the operators for training data."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
PROBE = "import __spark_entry__ as e; q = e.queries(); assert q and not [n for n in q if n.startswith('op') and n[2].isdigit()]; assert 'pipeline' not in q; assert set(e.oracle_sql()) == set(q)"


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_entry_stands_without_the_training_operators(tmp_path, with_pipeline):
    copy = tmp_path / "copy"
    left_out = ["llm", ".git", "__pycache__", ".pytest_cache"] + ([] if with_pipeline else ["corpus_pipeline.py"])
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(*left_out))
    done = subprocess.run([sys.executable, "-c", PROBE], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
