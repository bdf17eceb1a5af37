import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; print(sum(n[:2] == 'op' for n in e.queries()), len(e.oracle_sql().keys() - e.queries().keys()))"


def _run(folder):
    done = subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, check=True)
    return done.stdout.split()


def test_entry_works_without_the_training_data_package(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache"))
    assert _run(copy) == ["0", "0"]
    assert _run(ROOT)[1] == "0"
