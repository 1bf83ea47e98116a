"""The entry module where the subpackage on training data is not there."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_imports_without_the_subpackage(tmp_path):
    away = shutil.ignore_patterns("llm", ".git", "__pycache__", "spark-warehouse")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=away)
    code = (
        "import __spark_entry__ as e; names = set(e.queries());"
        "assert 'clean_entity' in names and 'pipeline' not in names, names;"
        "assert not any(n.startswith('op') and n[2:3].isdigit() for n in names);"
        "assert set(e.oracle_sql()) <= names"
    )
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True, timeout=120)
