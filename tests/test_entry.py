"""The entry points, with and without the removable training-data folder."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
SAY = "import __spark_entry__ as e; q = e.queries(); print(len(q), set(e.oracle_sql()) <= set(q), any(n.startswith('op') for n in q))"


def said(folder):
    return subprocess.run([sys.executable, "-c", SAY], cwd=folder, capture_output=True, text=True, check=True).stdout.split()


def test_entry_without_the_removable_folders(tmp_path):
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "slipstream", tmp_path / "slipstream", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    count, sound, training = said(tmp_path)
    assert int(count) > 100 and sound == "True" and training == "False"


def test_another_missing_module_is_an_error(tmp_path):
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "slipstream", tmp_path / "slipstream", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "corpus_pipeline.py").write_text("import a_module_that_nobody_has\n")
    found = subprocess.run([sys.executable, "-c", SAY], cwd=tmp_path, capture_output=True, text=True)
    assert found.returncode and "a_module_that_nobody_has" in found.stderr
