"""Leaderboards and listings. Each top-k keeps k rows per task before the last step."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskstream.functions import id_order, usable_amount
from riskstream.operators.filters import only_suspicious
from riskstream.operators.validate import require_columns
from riskstream.schema import FLAG


def suspicious_leaderboard(
    df: DataFrame, n: int = 10, *, names: DataFrame | None = None
) -> DataFrame:
    """Customers with the highest total of suspicious amounts.

    A customer is an id together with a name: two names make two entries. Where names
    are kept apart, one per id, give them as ``names``: totals are then made by id,
    ids without a name are dropped from the totals, and only the leaders are looked up.
    """
    customer = ["customer_id", "customer_name"] if names is None else ["customer_id"]
    require_columns(df, *customer)
    measures = {
        "suspicious_count": F.count(F.lit(1)),
        "total_amount": F.coalesce(F.sum(usable_amount()), F.lit(0.0)),
        "last_seen": F.max("timestamp"),
    }
    totals = (
        only_suspicious(df)
        .dropna(subset=customer)
        .groupBy(*customer)
        .agg(*(value.alias(name) for name, value in measures.items()))
    )
    if names is not None:
        names = names.dropna(subset=["customer_id", "customer_name"])
        totals = totals.join(names.select("customer_id"), "customer_id", "left_semi")
    leaders = totals.orderBy(F.desc("total_amount"), *customer).limit(n)
    if names is None:
        return leaders
    named = leaders.join(names.select("customer_id", "customer_name"), "customer_id")
    return named.select("customer_id", "customer_name", *measures).orderBy(
        F.desc("total_amount"), "customer_id"
    )


def _newest_first(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("timestamp"), *id_order(descending=True))


def recent_suspicious(df: DataFrame, n: int = 10) -> DataFrame:
    """The newest suspicious transactions, all columns."""
    return _newest_first(only_suspicious(df)).limit(n)


def latest_suspicious(df: DataFrame, n: int = 10) -> DataFrame:
    """The newest suspicious transactions, as listed on the dashboard."""
    return recent_suspicious(df, n).select("timestamp", "customer_id", "amount", "location")


def recent_transactions(df: DataFrame, n: int = 10) -> DataFrame:
    """The newest transactions, all columns."""
    return _newest_first(df).limit(n).withColumn(FLAG, F.col(FLAG).cast("boolean"))


def suspicious_listing(df: DataFrame) -> DataFrame:
    """Every suspicious transaction, newest first."""
    wanted = ("transaction_id", "customer_id", "merchant", "amount", "timestamp")
    return _newest_first(only_suspicious(df).select(*wanted))


def suspicious_preview(df: DataFrame, n: int = 5) -> DataFrame:
    """A few suspicious transactions, the lowest ids."""
    return only_suspicious(df).orderBy(*id_order()).limit(n)
