"""The library without its optional parts."""
import os
import shutil
import subprocess
import sys

import pytest

from conftest import ROOT

CODE = """
import __spark_entry__ as e
names = set(e.queries())
assert names == {n for n in e.queries()} and set(e.oracle_sql()) <= names and "mart_usage" in names
print(sum(n.startswith("op") or n == "pipeline" for n in names))
"""


@pytest.mark.parametrize("gone", [("ledgerline/llm", "tests/llm", "corpus_pipeline.py"), ("ledgerline/llm", "tests/llm"), ("corpus_pipeline.py",)])
def test_entry_without_optional_parts(tmp_path, gone):
    keep = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache")
    copy = shutil.copytree(ROOT, tmp_path / "copy", ignore=lambda d, names: keep(d, names) | {
        n for n in names if os.path.relpath(os.path.join(d, n), ROOT) in gone})
    assert not any(os.path.exists(copy / g) for g in gone)
    out = subprocess.run([sys.executable, "-c", CODE], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(copy)})
    assert out.returncode == 0, out.stderr
    left = int(out.stdout)
    assert (left == 0) == ("ledgerline/llm" in gone)


def test_other_missing_modules_are_errors():
    import __spark_entry__ as e
    with pytest.raises(ModuleNotFoundError):
        e._optional("no_such_module")
