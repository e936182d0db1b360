"""The driver contract holds with and without the text-preparation subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

REPO = Path(__file__).resolve().parents[1]


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_subpackage(tmp_path):
    (tmp_path / "chatlake").mkdir()
    for p in (REPO / "chatlake").iterdir():
        if p.name not in ("llm", "__pycache__"):
            (shutil.copytree if p.is_dir() else shutil.copy)(p, tmp_path / "chatlake" / p.name)
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and not any(n.startswith('op') and n[2].isdigit() or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
