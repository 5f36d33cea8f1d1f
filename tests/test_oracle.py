"""Every registered query against its SQL on the whole tables."""

import pytest

from __spark_entry__ import entry
from check import compare, connect
from tests.conftest import SF
from workload.oracle import oracle_sql
from workload.queries import WITHOUT_SQL, queries


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(queries()) - WITHOUT_SQL == set(oracle_sql())


@pytest.mark.parametrize("name", [name for name in queries() if name not in WITHOUT_SQL])
def test_query(spark, con, name):
    equal, rows, detail = compare(spark, con, name, SF)
    assert equal, detail
    assert rows > 0


def test_entry(spark):
    assert entry(spark).count() == 15
