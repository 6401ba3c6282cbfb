"""Every registered query against its SQL on the smallest scale."""

from __future__ import annotations

import pytest

from lodgeframe.queries import QUERIES, Tables
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    entry = QUERIES[name]
    df = entry.run(Tables(spark, SF))
    if entry.sql is None:
        assert df.count() > 0
    else:
        assert differences(df, con, entry.sql) == []
