"""Headline figures and counts by one column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskstream.operators.measures import ROWS, average, measured, total
from riskstream.schema import FLAG


def kpis(df: DataFrame) -> DataFrame:
    """One row of headline figures; all 0 when there are no transactions."""
    figures = measured(df).agg(
        total(ROWS).alias("total"),
        total(ROWS, FLAG).alias("suspicious"),
        average().alias("mean"),
    )
    share = F.try_divide(F.col("suspicious"), F.col("total")) * 100
    return figures.select(
        "total",
        "suspicious",
        (F.col("total") - F.col("suspicious")).alias("normal"),
        F.coalesce(F.round(share, 2), F.lit(0.0)).alias("suspicious_pct"),
        F.coalesce(F.round("mean", 2), F.lit(0.0)).alias("avg_amount"),
    )


def suspicious_split(df: DataFrame) -> DataFrame:
    """Number of suspicious and of normal transactions: always two rows."""
    return kpis(df).unpivot([], ["suspicious", "normal"], "category", "transactions")


def counts_by(df: DataFrame, column: str) -> DataFrame:
    """Transactions per value, most first. Rows without a value are left out."""
    return (
        measured(df)
        .where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(total(ROWS).alias("transactions"))
        .orderBy(F.desc("transactions"), column)
    )


def avg_amount_by(df: DataFrame, column: str) -> DataFrame:
    """Average amount per value. Rows without a value are left out."""
    return (
        measured(df)
        .where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(average().alias("avg_amount"))
        .orderBy(column)
    )


def status_counts(df: DataFrame) -> DataFrame:
    return counts_by(df, "status")


def avg_amount_by_status(df: DataFrame) -> DataFrame:
    return avg_amount_by(df, "status")


def location_counts(df: DataFrame) -> DataFrame:
    return counts_by(df, "location")


def card_type_distribution(df: DataFrame) -> DataFrame:
    """Transactions and average amount per card type."""
    return (
        measured(df)
        .where(F.col("card_type").isNotNull())
        .groupBy("card_type")
        .agg(total(ROWS).alias("transactions"), average().alias("avg_amount"))
        .orderBy(F.desc("transactions"), "card_type")
    )


def location_hotspots(df: DataFrame) -> DataFrame:
    """Suspicious transactions and their share per location, most first."""
    share = F.col("suspicious") / F.col("transactions") * 100
    return (
        measured(df)
        .where(F.col("location").isNotNull())
        .groupBy("location")
        .agg(total(ROWS).alias("transactions"), total(ROWS, FLAG).alias("suspicious"))
        .select("*", F.round(share, 2).alias("suspicious_pct"))
        .orderBy(F.desc("suspicious"), "location")
    )
