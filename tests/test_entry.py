"""The entry points without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_points_without_the_subpackage(tmp_path):
    away = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(f"{ROOT}/moodstream", tmp_path / "moodstream", ignore=away)
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; names = set(e.queries()); assert set(e.oracle_sql()) <= names; print(len(names), any(x.startswith('op') or x == 'pipeline' for x in names))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
    number, own = done.stdout.split()
    assert int(number) > 60 and own == "False"
