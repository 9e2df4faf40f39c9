"""The library stands without the training-data operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = "import __spark_entry__ as e; q = e.queries(); assert not any(n[:2] == 'op' and n[2].isdigit() or n == 'pipeline' for n in q); print(len(q), len(e.oracle_sql()))"


def test_entry_without_the_operators(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache"))
    done = subprocess.run([sys.executable, "-c", PROBE], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    queries, oracles = map(int, done.stdout.split())
    assert queries >= 120 and oracles >= 120


def test_other_import_errors_are_not_hidden(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache"))
    (copy / "corpus_pipeline.py").write_text("import no_such_module\n")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode != 0 and "no_such_module" in done.stderr
