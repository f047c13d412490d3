import pytest

from marquee.llm import queries

from oracle import connect


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_oracle(spark, name):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES[name](spark, sf)
    names = ", ".join(f'"{c}"' for c in got.columns)
    expected = connect(sf).execute(f"SELECT {names} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(expected)
