"""Every query against its SQL counterpart on the same tables."""

import os

import pytest

import __spark_entry__ as entry_module
from compare import database, spark_rows, sql_rows
from newslake.plans.oracles import all_oracles
from newslake.plans.queries import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    got = spark_rows(entry_module.queries()[name](spark, SF_DIR))
    assert got == sql_rows(db, entry_module.oracle_sql()[name])
