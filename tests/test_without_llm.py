"""The rest works where the training-data operators are not there."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as registry

ROOT = Path(registry.__file__).parent


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_copy_without_the_operators(tmp_path, with_pipeline):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if with_pipeline else ["corpus_pipeline.py"])))
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.QUERIES) == sorted(e.oracle_sql()), len(e.QUERIES))"
    run = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=300)
    assert run.stdout.split() == ["True", str(len(registry.QUERIES))], run.stderr
    collected = subprocess.run(
        [sys.executable, "-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider"], cwd=copy, capture_output=True, text=True, timeout=300
    )
    assert collected.returncode == 0 and "error" not in collected.stdout.splitlines()[-1], collected.stdout[-500:]
