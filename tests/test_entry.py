"""The entry in a copy of the repository that lacks the training-text operators."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
import __spark_entry__ as entry
names = set(entry.queries())
assert "sales_order" in names and not any(n == "pipeline" or n.startswith("op1") for n in names), names
assert set(entry.oracle_sql()) <= names
"""


@pytest.mark.parametrize("emptied", [False, True])
def test_entry_stands_without_the_subpackage(tmp_path, emptied):
    copy = tmp_path / "copy"
    left_out = shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py")
    shutil.copytree(ROOT, copy, ignore=left_out)
    if emptied:
        (copy / "shopfloor" / "llm").mkdir()
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_other_missing_modules_are_errors(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py"))
    (copy / "shopfloor" / "llm").mkdir()
    (copy / "shopfloor" / "llm" / "__init__.py").touch()
    (copy / "shopfloor" / "llm" / "registry.py").write_text("import no_such_module\n")
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, capture_output=True, text=True, timeout=120)
    assert "no_such_module" in done.stderr
