"""Every registered query against its SQL, and the known totals."""

import pytest

import __spark_entry__ as entry
from check_oracle import connection, spark_result, sql_result

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.CORE))
def test_query(spark, duck, name):
    got = spark_result(entry.queries()[name](spark, SF_DIR))
    assert got == sql_result(duck, entry.oracle_sql()[name])


def test_entry(spark):
    assert entry.entry(spark).count() == 10


def test_known_totals(spark):
    run = entry.queries()
    kpis = run["kpis"](spark, SF_DIR).first()
    assert (kpis.total, kpis.suspicious, kpis.suspicious_pct) == (15000, 6033, 40.22)
    assert kpis.avg_amount == 250562.64
    sampled = run["sampled_kpis"](spark, SF_DIR).first()
    assert (sampled.total, sampled.suspicious, sampled.avg_amount) == (1584, 599, 243835.27)
    assert run["monthly_sample"](spark, SF_DIR).count() == 2372
    assert run["amount_outliers"](spark, SF_DIR).count() == 189
    upserted = run["flag_upsert"](spark, SF_DIR)
    disagree = upserted.where("is_suspicious <> (amount > 45)").count()
    assert (upserted.count(), disagree) == (750, 365)
    assert run["monthly_volume_gaps"](spark, SF_DIR).where("transactions = 0").count() == 30
