"""Workers find the package although only the driver has it on its search path."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]
CODE = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from chatlake.session import local_session
from chatlake.sources.sqlite_archive import read_archive
spark = local_session(2, 2)
print("rows", read_archive(spark, "a.sqlite", "MESSAGE").count())
"""


def test_workers_find_the_package(tmp_path):
    from tests.archive import fixture_a

    fixture_a(tmp_path / "a.sqlite").close()
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "rows 4" in done.stdout, done.stderr[-2000:]
