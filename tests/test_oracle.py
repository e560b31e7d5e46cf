"""Every registered query with an oracle gives the oracle's rows."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, diff

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    assert diff(entry.queries()[name](spark, FOLDER), duck, entry.oracle_sql()[name]) == ""


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
