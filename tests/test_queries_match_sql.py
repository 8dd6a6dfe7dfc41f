import pytest
from compare import differences

from __spark_entry__ import entry, oracle_sql, queries
from cyclemart.plans.oracle import ORACLE
from cyclemart.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_every_query_of_the_warehouse_has_sql():
    assert QUERIES.keys() == ORACLE.keys() and QUERIES.keys() <= queries().keys() and oracle_sql().keys() <= queries().keys()


def test_entry(spark):
    df = entry(spark)
    assert "v_realizado" in df.columns and df.limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    assert differences(queries()[name](spark, FOLDER), oracle_sql()[name], FOLDER) is None
