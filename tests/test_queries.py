import inspect
import re

import pytest

import __spark_entry__ as contract
from tablemill.plans.registry import ORACLES, QUERIES
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_flagship(spark):
    assert contract.entry(spark).count() == 1500


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, duck, name):
    assert compare(contract.queries()[name](spark, SF_DIR), duck, contract.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_schema_is_stable(spark, name):
    if re.search("refresh|csv|load|insert|upsert|update|delete|merge|multi|statement", name):
        pytest.skip("writes; run once above")
    function = contract.queries()[name]
    assert function(spark, SF_DIR).schema == function(spark, SF_DIR).schema
    assert list(inspect.signature(function).parameters) == ["spark", "sf_dir"]
