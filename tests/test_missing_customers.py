"""Orders whose customer or nation is missing: every query of transactions still equals its SQL."""

import pytest

import __spark_entry__ as entry
from check_oracle import connection, spark_result, sql_result

SF_DIR = "/root/testdata/sf0.001"
NAMES = sorted(name for name in entry.CORE if "transactions AS (" in entry.ORACLE.get(name, ""))


@pytest.fixture(scope="module")
def gaps(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("gaps"))
    changes = {"customer": "c_custkey % 7 <> 3", "nation": "n_nationkey % 5 <> 1", "orders": "true", "region": "true"}
    for name, kept in changes.items():
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").where(kept).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, gaps, name):
    got = spark_result(entry.queries()[name](spark, gaps))
    assert got == sql_result(connection(gaps), entry.oracle_sql()[name])


def test_top_n_are_complete(spark, gaps):
    run = entry.queries()
    for name in ("recent_transactions", "latest_suspicious", "suspicious_leaderboard", "suspicious_leaderboard_by_name"):
        assert run[name](spark, gaps).count() == 10
    assert run["suspicious_preview"](spark, gaps).count() == 5
