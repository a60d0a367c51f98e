"""The library and the driver's entry stand without the package for training data."""

import re
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_the_rest_stands_alone(tmp_path):
    for name in ("stockflow", "__spark_entry__.py", "bench.py"):
        source = ROOT / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e, bench; from stockflow.testbed.queries import QUERIES; assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


def test_nothing_else_imports_the_package():
    for file in (ROOT / "stockflow").rglob("*.py"):
        if "llm" not in file.parts:
            assert not re.search(r"\bllm\b", file.read_text()), file
