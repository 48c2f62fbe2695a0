"""Every registered query against its SQL on the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    frame = queries()[name](spark, FOLDER)
    if name in ORACLES:
        assert difference(frame, duck, ORACLES[name]) is None
    else:
        assert frame.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["city_code", "trips", "avg_fare"]
    assert entry(spark).count() > 0
