"""The registered queries that SQL can state, against it."""

from __future__ import annotations

import pytest

from lodgeframe.llm.queries import QUERIES, SQL
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", SQL)
def test_query(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), SQL[name]) == []
