"""Every registered query against its SQL twin."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from check import compare, connect

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
# the text operators have tests of their own
QUERIES = {k: v for k, v in entry_point.queries().items() if k not in entry_point.LLM_QUERIES}
ORACLES = {k: v for k, v in entry_point.oracle_sql().items() if k not in entry_point.LLM_ORACLES}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_names_agree():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    if name in ORACLES:
        assert compare(spark, duck, SF, name, QUERIES[name], ORACLES[name]) is None
    else:
        assert QUERIES[name](spark, SF).count() >= 0


@pytest.mark.parametrize("gone", [("llm",), ("llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_text_operators_can_be_removed(tmp_path, gone):
    root = Path(entry_point.__file__).parent
    shutil.copytree(root / "cohortry", tmp_path / "cohortry", ignore=shutil.ignore_patterns("__pycache__", *gone))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in gone and (root / name).exists():
            shutil.copy(root / name, tmp_path)
    code = "import __spark_entry__ as e; print(len(set(e.queries()) - set(e.LLM_QUERIES)), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    assert int(said.stdout.split()[0]) == len(QUERIES)
