"""Every registered query against its SQL on the smallest tables; larger ones: python tests/check_oracles.py."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from catalog.oracles import ORACLES
from catalog.queries import QUERIES
from check_oracles import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert entry_point.oracle_sql().keys() <= entry_point.queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    assert compare(spark, connection, FOLDER, name) is None


def test_entry(spark):
    rows = entry_point.entry(spark)
    assert rows.count() == 150 and {"risk_score", "risk_category", "risk_factors"} <= set(rows.columns)
