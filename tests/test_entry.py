"""The driver contract, with and without the optional subpackage."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__

ROOT = Path(__file__).resolve().parent.parent
ASK = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


@pytest.mark.parametrize("gone", [["skumill/llm", "tests/llm", "corpus_pipeline.py"], ["skumill/llm", "tests/llm"], ["corpus_pipeline.py"]])
def test_the_rest_works_without_the_optional_parts(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse"))
    for name in gone:
        target = copy / name
        if target.is_dir():
            shutil.rmtree(target)
        else:
            target.unlink(missing_ok=True)
    got = subprocess.run([sys.executable, "-c", ASK], cwd=copy, capture_output=True, text=True, check=True).stdout.splitlines()
    names, sql = set(got[-2].split()), set(got[-1].split())
    assert "reconcile_first_match" in names and "reconcile_first_match" in sql
    assert "pipeline" not in names
    if "skumill/llm" in gone:
        assert not any(n.startswith("op") and n[2].isdigit() for n in names | sql)


def test_another_checkout_on_the_path_is_not_asked(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse", "corpus_pipeline.py"))
    ask = "import __spark_entry__ as e, skumill; print('pipeline' in e.queries()); print(e.__file__, skumill.__file__)"
    got = subprocess.run([sys.executable, "-c", ask], cwd=copy, env={**os.environ, "PYTHONPATH": str(ROOT)}, capture_output=True, text=True, check=True).stdout.splitlines()
    assert got[-2] == "False" and all(f.startswith(str(copy)) for f in got[-1].split())


def test_entry_gives_rows_of_a_stable_schema(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns[:2] == ["pos", "status"] and df.count() > 0
