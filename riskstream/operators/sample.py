"""Stratified sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from riskstream.functions import period_start, sample_order
from riskstream.schema import KEY


def monthly_sample(df: DataFrame, per_month: int = 30, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, per_month)`` transactions of each calendar month.

    The same rows on every run: the first of each month in a pseudo-random order of
    the ids. That order is by hash, and a hash with more leading zeros comes first,
    so counting the rows of a month by leading zeros tells how many a row needs to be
    among the first. Only the few rows that have them are sorted.
    """
    rows = df.where(F.col("timestamp").isNotNull()).withColumns(
        {"_month": period_start("month"), "_hash": sample_order(seed)}
    )
    zeros = F.length("_hash") - F.length(F.ltrim("_hash", F.lit("0")))
    counted = rows.groupBy("_month", zeros.alias("zeros")).count()
    from_top = Window.partitionBy("_month").orderBy(F.desc("zeros"))
    # The most zeros that still leave enough rows, or none. One row per calendar month, of
    # which the accepted years have 3,600; the planner broadcasts it if it is small.
    needed = (
        counted.withColumn("reached", F.sum("count").over(from_top))
        .groupBy("_month")
        .agg(F.coalesce(F.max(F.when(F.col("reached") >= per_month, F.col("zeros"))), F.lit(0)).alias("needed"))
    )
    first = Window.partitionBy("_month").orderBy("_hash", KEY)
    return (
        rows.join(needed, "_month")
        .where(zeros >= F.col("needed"))
        .withColumn("_place", F.row_number().over(first))
        .where(F.col("_place") <= per_month)
        .select(*df.columns)
    )
