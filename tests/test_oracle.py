"""Every query against its SQL, at the smallest scale factor."""

import os

import pytest

import __spark_entry__ as driver
import check_oracle
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return check_oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    outcome, _, _ = check_oracle.compare(spark, connection, name, SF)
    assert outcome.startswith("ok"), outcome


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[0] == "id" and df.count() > 0
