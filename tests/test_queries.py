"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import pytest

from tests.compare import compare, connect
from workload import CASES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(CASES))
def test_query(spark, duck, name):
    assert compare(spark, duck, CASES[name], SF) == []


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
