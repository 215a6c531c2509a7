import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not here")


def test_every_query_has_an_oracle():
    own = {name for name in contract.queries() if not name.startswith("op") and name != "pipeline"}
    assert own <= set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship_query(spark):
    df = contract.entry(spark)
    assert df.columns[:4] == ["product_key", "retailer_key", "source", "retailer_product_id"]
    assert df.count() > 0


@pytest.mark.parametrize(
    "name", ["I3_state_changes", "I8_price_changes_lineitem", "M10_mart_retailer_summary", "X1_outages"]
)
def test_against_oracle(spark, name):
    db = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        db.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    got = contract.queries()[name](spark, SF_DIR)
    want = db.sql(contract.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    left = sorted(map(repr, (tuple(r) for r in got.select(columns).collect())))
    right = sorted(map(repr, want.select(*columns).fetchall()))
    assert left == right
