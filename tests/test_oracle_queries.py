"""Every registered query against its SQL counterpart."""

import oracle
import pytest

import __spark_entry__ as entry
from ledgerline.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert oracle.compare(con, entry.oracle_sql()[name], entry.queries()[name](spark, SF)) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert "HK_CUSTOMER" in df.columns
    assert df.count() > 0
