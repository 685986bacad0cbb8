"""The queries that SQL can express against their SQL."""

import oracle
import pytest

from ledgerline.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, name):
    assert oracle.compare(oracle.connect(SF), ORACLES[name], QUERIES[name](spark, SF)) is None
