"""Every registered query against its SQL, on whole tables."""

import pytest

from checks.compare import connect, differences
from checks.oracle import ORACLE
from checks.queries import QUERIES
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert differences(spark, con, SF, name) is None
