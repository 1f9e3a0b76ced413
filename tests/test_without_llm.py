"""The library imports and lists its queries when the optional subpackage is gone; other import errors show."""

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent


def _names(folder):
    code = "import __spark_entry__ as e; print('NAMES', len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, timeout=300)


def test_without_the_subpackage(tmp_path):
    skip = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse")
    shutil.copytree(REPO, tmp_path / "bare", ignore=skip)
    out = _names(tmp_path / "bare")
    assert "NAMES" in out.stdout and out.stdout.strip().endswith("False"), out.stderr[-800:]


def test_nothing_outside_imports_it():
    for path in REPO.glob("cropcube/**/*.py"):
        if "llm" not in path.relative_to(REPO).parts:
            assert "cropcube.llm" not in path.read_text(), path


def test_other_import_errors_are_not_swallowed(tmp_path):
    if not (REPO / "corpus_pipeline.py").exists():
        return
    shutil.copytree(REPO, tmp_path / "broken", ignore=shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse"))
    (tmp_path / "broken/corpus_pipeline.py").write_text("import a_module_that_is_not_there\n")
    out = _names(tmp_path / "broken")
    assert out.returncode and "a_module_that_is_not_there" in out.stderr
