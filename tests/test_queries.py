"""Every named query against its SQL on DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from perkwell.plans.check_sql import check_sql
from perkwell.plans.registry import QUERIES

DIRECTORY = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="no retail tables here")
KINDS = {"long": "BIGINT", "integer": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(DIRECTORY):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{DIRECTORY}/{file}'")
    yield con
    con.close()


def test_every_query_has_a_check():
    assert set(QUERIES) == set(check_sql())
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def compare(spark, duck, name):
    df = contract.queries()[name](spark, DIRECTORY)
    order = sorted(df.columns)
    sql = contract.oracle_sql()[name]
    kinds = {row[0]: row[1] for row in duck.execute(f"DESCRIBE {sql}").fetchall()}
    assert kinds == {f.name: KINDS[f.dataType.typeName()] for f in df.schema}
    result = duck.execute(sql)
    place = {d[0]: i for i, d in enumerate(result.description)}
    theirs = sorted(repr([r[place[c]] for c in order]) for r in result.fetchall())
    ours = sorted(repr([r[c] for c in order]) for r in df.collect())
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    compare(spark, duck, name)


@pytest.mark.parametrize("name", [
    "seasonal_item_performance", "order_type_comparison", "setmeal_profitability", "redeem_seasonal",
    "redeem_vouchers", "bulk_assign_vouchers", "create_alacarte_orders", "cascade_delete", "sync_order_totals",
])
def test_query_when_nothing_fits_a_broadcast(spark, duck, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        compare(spark, duck, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
