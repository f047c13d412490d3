import pytest

from oracle import TESTDATA, compare, connect
from workload import ORACLES, QUERIES

SF = str(TESTDATA / "sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_oracle(spark, duck, name):
    problem, _ = compare(spark, duck, name, SF)
    assert not problem
