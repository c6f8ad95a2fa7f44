"""The library without its corpus operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _copy_without(tmp_path, *gone):
    keep = shutil.ignore_patterns(".git", "__pycache__", "*.json", "llm", *gone)
    return shutil.copytree(ROOT, tmp_path / "copy", ignore=keep)


def _run(copy, *command):
    env = {**os.environ, "PYTHONPATH": str(copy)}
    return subprocess.run([sys.executable, *command], cwd=copy, env=env, capture_output=True, text=True, timeout=300)


def test_entry_without_the_corpus_operators(tmp_path):
    code = (
        "import __spark_entry__ as e; q = e.queries(); "
        "assert 'feature_table' in q and 'pipeline' not in q and not any(k[:2] == 'op' for k in q); "
        "assert set(e.oracle_sql()) <= set(q)"
    )
    for name, gone in (("with", ()), ("without", ("corpus_pipeline.py",))):
        copy = _copy_without(tmp_path / name, *gone)
        assert not (copy / "wardspan" / "llm").exists()
        done = _run(copy, "-c", code)
        assert done.returncode == 0, done.stderr


def test_other_tests_collect_without_the_corpus_operators(tmp_path):
    copy = _copy_without(tmp_path)
    done = _run(copy, "-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider")
    assert done.returncode == 0, done.stdout[-2000:]
