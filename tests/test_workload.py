"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as entry
from oracle import difference
from workload import ORACLE, QUERIES


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, folder, name):
    assert name in ORACLE
    assert difference(QUERIES[name](spark, folder), con, ORACLE[name]) is None


def test_flagship_gives_rows(spark):
    assert entry.entry(spark).count() > 0
