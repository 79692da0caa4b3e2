"""The library and its registry without the text operators, in a copy that does not hold them."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
import __spark_entry__ as registry
from checks.queries import QUERIES
import parcelry.plans.jobs, parcelry.streaming.scoring
assert set(registry.queries()) == set(QUERIES), set(registry.queries()) ^ set(QUERIES)
assert set(registry.oracle_sql()) <= set(QUERIES)
"""


def test_imports_without_the_text_operators(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: {n for n in names if n in (".git", "llm", "__pycache__")})
    assert not (copy / "parcelry" / "llm").exists()
    ran = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert ran.returncode == 0, ran.stderr


def test_nothing_else_names_the_text_package():
    for path in [*(ROOT / "parcelry").rglob("*.py"), *(ROOT / "checks").rglob("*.py")]:
        if "llm" not in path.relative_to(ROOT).parts:
            assert "parcelry.llm" not in path.read_text(), path
