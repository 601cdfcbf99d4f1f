"""Every query against its SQL twin on the given tables."""

from __future__ import annotations

import os

import pytest
from compare import differences, duck

import __spark_entry__ as entry
from orderflow.plans import catalog, oracle

DIRECTORY = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def engine():
    return duck(DIRECTORY)


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, engine, name):
    frame = entry.queries()[name](spark, DIRECTORY)
    assert differences(frame, engine, entry.oracle_sql()[name]) is None
