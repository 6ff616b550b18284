"""The driver's contract, with and without the corpus operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as e

ROOT = Path(e.__file__).parent


def test_names():
    assert len(e.queries()) > 50
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").is_dir(), reason="no test tables")
def test_flagship(spark):
    out = e.entry(spark)
    assert out.columns == ["category", "status", "n"] and out.count() > 0


def test_without_the_corpus_operators(tmp_path):
    ignore = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "tests", "__pycache__")
    shutil.copytree(ROOT, tmp_path / "r", ignore=ignore)
    code = "import __spark_entry__ as e, sys; q = e.queries(); assert not any(k.startswith('op') and k[2].isdigit() for k in q) and 'pipeline' not in q; assert not any('llm' in m for m in sys.modules if m.startswith('feedmill')); print(len(q), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr


def test_nothing_else_imports_the_corpus_operators():
    for p in (ROOT / "feedmill").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert "feedmill.llm" not in p.read_text() and "from .llm" not in p.read_text() and "..llm" not in p.read_text(), p
