"""Series over calendar months or days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from riskstream.functions import month_label, period_start
from riskstream.operators.measures import ROWS, average, measured, total
from riskstream.schema import FLAG


def trend(df: DataFrame, grain: str = "month") -> DataFrame:
    """Transactions and average amount per period, without gaps.

    Periods between the first and the last that have no transaction appear with
    a count of 0 and no average. Each period found is stretched up to the next
    one, so the table is read once and nothing is joined; the window sees one row
    per period, and one task fills the gaps, which the accepted years bound to some 110,000 days.
    """
    found = (
        measured(df)
        .where(F.col("timestamp").isNotNull())
        .groupBy(period_start(grain).alias("found"))
        .agg(total(ROWS).alias("found_count"), average().alias("found_avg"))
    )
    following = F.lead("found").over(Window.orderBy("found"))
    last = F.add_months(following, -1) if grain == "month" else F.date_sub(following, 1)
    step = F.expr(f"interval 1 {grain}")
    stretched = found.withColumn("last", F.coalesce(last, F.col("found"))).select(
        "*", F.explode(F.sequence("found", "last", step)).alias(grain)
    )
    real = F.col(grain) == F.col("found")
    return stretched.select(
        grain,
        F.when(real, F.col("found_count")).otherwise(0).alias("transactions"),
        F.when(real, F.col("found_avg")).alias("avg_amount"),
    )


def _labelled(series: DataFrame, grain: str, value: str) -> DataFrame:
    label = [month_label(grain).alias("month_label")] if grain == "month" else []
    return series.select(grain, *label, value).orderBy(grain)


def volume(df: DataFrame, grain: str = "month") -> DataFrame:
    """Transactions per period, 0 where there are none."""
    return _labelled(trend(df, grain), grain, "transactions")


def average_amount(df: DataFrame, grain: str = "month") -> DataFrame:
    """Average amount per period, null where there are no transactions."""
    return _labelled(trend(df, grain), grain, "avg_amount")


def suspicious_by_month(df: DataFrame) -> DataFrame:
    """Suspicious transactions per month that has any, most first."""
    return (
        measured(df.where(F.col(FLAG) & F.col("timestamp").isNotNull()))
        .groupBy(period_start("month").alias("month"))
        .agg(total(ROWS).alias("transactions"))
        .select("month", month_label("month").alias("month_label"), "transactions")
        .orderBy(F.desc("transactions"), "month")
    )
