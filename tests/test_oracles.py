"""Every query that SQL can express gives the same rows in a second engine."""

import pytest
from compare import connect, differences

from sparktab.plans.oracles import ORACLES
from sparktab.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, con, name):
    rows, problem = differences(name, spark, con, SF)
    assert problem == ""
    assert rows > 0


def test_every_counterpart_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
