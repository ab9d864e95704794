import pytest

import __spark_entry__ as entry
from ledgerline.plans.registry import ORACLE_SQL, QUERIES
from tests.conftest import SF01
from tests.oracle_compare import compare, duck_connection


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["security_id", "trade_date_str", "total_volume", "avg_price"]
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    res = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql()[name], SF01)
    assert res["columns_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["type_diff"] == {}, res
    assert res["exact"], res
