"""The entry module loads with and without the optional parts."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(set(e.oracle_sql()) - set(q)), 'pipeline' in q)"


def _copy(to: Path, gone: tuple[str, ...]) -> Path:
    shutil.copytree(REPO, to, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for name in gone:
        target = to / name
        if target.is_dir():
            shutil.rmtree(target)
        else:
            target.unlink(missing_ok=True)
    return to


@pytest.mark.parametrize("gone", [("martspark/llm", "tests/llm"), ("martspark/llm", "tests/llm", "corpus_pipeline.py")])
def test_entry_loads_without_the_optional_parts(tmp_path, gone):
    from martspark.catalog import QUERIES

    repo = _copy(tmp_path / "repo", gone)
    said = subprocess.run([sys.executable, "-c", COUNT], cwd=repo, capture_output=True, text=True, check=True).stdout
    assert said.split() == [str(len(QUERIES)), "0", "False"]
