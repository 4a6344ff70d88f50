"""The busiest locations: counts, distribution of amounts, outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskstream.functions import flag_or_false, usable_amount
from riskstream.operators.breakdown import counts_by
from riskstream.operators.measures import ROWS, measured, total
from riskstream.operators.quantiles import quantiles
from riskstream.schema import FLAG
from riskstream.session import stored

WHISKER = 1.5


def top_locations(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` locations with most transactions."""
    return counts_by(df, "location").limit(n)


def top_location_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """Rows of the ``n`` busiest locations.

    The list broadcast has ``n`` short rows whatever the size of the table.
    """
    return df.join(F.broadcast(top_locations(df, n).select("location")), "location", "left_semi")


def top_location_histogram(df: DataFrame, n: int = 10) -> DataFrame:
    """Transactions by location and flag for the busiest locations.

    One pass: both counts are taken per location, the top ``n`` kept, and only
    those turned into rows.
    """
    top = (
        measured(df)
        .where(F.col("location").isNotNull())
        .groupBy("location")
        .agg(total(ROWS).alias("transactions"), total(ROWS, FLAG).alias("suspicious"))
        .orderBy(F.desc("transactions"), "location")
        .limit(n)
    )
    counts = F.create_map(
        F.lit(True), F.col("suspicious"),
        F.lit(False), F.col("transactions") - F.col("suspicious"),
    )
    return (
        top.select("location", F.explode(counts).alias(FLAG, "transactions"))
        .where(F.col("transactions") > 0)
        .orderBy("location", FLAG)
    )


def box_stats(
    df: DataFrame,
    keys: Sequence[str] = ("location", FLAG),
    *,
    accuracy: int | None = None,
) -> DataFrame:
    """Five-number summary of the amount and the outlier fences, per group.

    Quartiles interpolate linearly between neighbouring values. They are exact
    unless ``accuracy`` asks for approximate ones, or a summary with sketches is given in place of the rows.
    """
    rows = df.withColumn(FLAG, flag_or_false()) if FLAG in keys else df
    summary = quantiles(rows, keys, "amount", (0.25, 0.5, 0.75), accuracy=accuracy)
    q1, q3 = F.col("quantiles")[0], F.col("quantiles")[2]
    reach = WHISKER * (q3 - q1)
    return summary.select(
        *keys,
        F.col("n").alias("transactions"),
        F.col("low").alias("min_amount"),
        q1.alias("q1"),
        F.col("quantiles")[1].alias("median"),
        q3.alias("q3"),
        F.col("high").alias("max_amount"),
        (q1 - reach).alias("lower_fence"),
        (q3 + reach).alias("upper_fence"),
    )


def top_location_box(
    df: DataFrame,
    n: int = 10,
    *,
    counted: DataFrame | None = None,
    accuracy: int | None = None,
) -> DataFrame:
    """Distribution of the amount by location and flag, busiest locations only.

    The locations are found first, by counting; a summary of the rows, given as ``counted``,
    saves that pass.
    """
    busiest = stored(top_locations(df if counted is None else counted, n).select("location"), "top-locations")
    return box_stats(df.join(F.broadcast(busiest), "location", "left_semi"), accuracy=accuracy)


def amount_outliers(
    df: DataFrame, keys: Sequence[str] = ("location", FLAG), *, accuracy: int | None = None
) -> DataFrame:
    """Rows whose amount lies outside the fences of their group.

    The fences come from a stored table, so the planner broadcasts them only if
    they are small; rows then stay where they are.
    """
    fences = box_stats(df, keys, accuracy=accuracy).select(*keys, "lower_fence", "upper_fence")
    rows = df.withColumn(FLAG, flag_or_false()) if FLAG in keys else df
    amount = usable_amount()
    outside = (amount < F.col("lower_fence")) | (amount > F.col("upper_fence"))
    return rows.join(fences, list(keys)).where(outside).drop("lower_fence", "upper_fence")
