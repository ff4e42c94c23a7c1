"""Every registered query against its oracle, on the smallest tables."""

import pytest

from checks import ORACLE, QUERIES
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
EMPTY_HERE = {"basis_synthetic"}  # no strike is listed on both sides in so few rows


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in ORACLE:
        assert compare(spark, con, SF_DIR, QUERIES[name], ORACLE[name], name in EMPTY_HERE) == []
    else:
        assert QUERIES[name](spark, SF_DIR).count() > 0
