"""The registered queries, their SQL, and the library without this part."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from tidelake.llm.queries import ORACLE, QUERIES

ROOT = Path(entry.__file__).resolve().parent


def test_one_query_per_operator():
    assert sorted(int(name.split("_")[0][2:]) for name in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, small, name):
    assert compare(spark, connect(small), QUERIES[name], ORACLE[name], small) == ""


def test_the_rest_works_without_this_part(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", ".pytest_cache"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not [n for n in q if n.startswith('op') or n == 'pipeline']; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True, timeout=120)


def test_a_broken_import_is_not_hidden(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    (tmp_path / "repo" / "tidelake" / "llm" / "packing.py").write_text("import no_such_library\n")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120)
    assert done.returncode and "no_such_library" in done.stderr
