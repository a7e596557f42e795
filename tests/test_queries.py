import pytest
from oracle import differences

from lexquarry import queries as registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES) and len(QUERIES) > 100


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, tmp_path, name):
    own, other, apart = differences(spark, sf_dir, QUERIES[name], SQL[name], str(tmp_path / "out"))
    assert own == other and apart == 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["id", "era", "source", "similarity", "account_type", "chain_strength", "conflict_flag"] and df.count() == 10


def _without(root, to, *gone):
    """A copy of everything in the repository but data, history and the folders or files named."""
    import shutil

    gone = {f"{root}/{g}" for g in gone}
    shutil.copytree(root, to, ignore=lambda d, names: [n for n in names if f"{d}/{n}" in gone or n in (".git", "__pycache__", ".pytest_cache")])


@pytest.mark.parametrize("gone", [("lexquarry/llm", "tests/llm"), ("lexquarry/llm", "tests/llm", "corpus_pipeline.py")])
def test_stands_alone_without_the_training_folders(tmp_path, gone):
    """The engine imports and its own tests run when the training-data folders are gone, with or without the pipeline's file."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    _without(root, tmp_path / "copy", *gone)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'pipeline' not in q and not any(k.startswith('op') for k in q if k[2:3].isdigit()); e.oracle_sql()"
    env = {**os.environ, "PYTHONPATH": str(tmp_path / "copy")}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", env=env, check=True)
    found = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only"], cwd=tmp_path / "copy", env=env, capture_output=True, text=True)
    assert found.returncode == 0, found.stdout[-2000:]
