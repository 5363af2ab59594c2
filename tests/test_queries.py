"""Every query of the feed library against its SQL on the same tables."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as contract
from railfeed.checks import EXPECTED, QUERIES


def test_every_query_has_sql():
    assert set(EXPECTED) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), duck, EXPECTED[name]) == []


def test_the_contract_has_them_all():
    assert set(QUERIES) <= set(contract.queries()) and EXPECTED.items() <= contract.oracle_sql().items()


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
