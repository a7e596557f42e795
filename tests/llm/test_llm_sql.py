import pytest
from oracle import differences

from lexquarry.llm import queries as registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, len(QUERIES) + 1))


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, tmp_path, name):
    own, other, apart = differences(spark, sf_dir, QUERIES[name], SQL[name], str(tmp_path / "out"))
    assert own == other and apart == 0
