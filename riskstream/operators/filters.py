"""Row filters and the values they offer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskstream.functions import flag_or_false
from riskstream.schema import FACETS, FLAG


def only_suspicious(df: DataFrame) -> DataFrame:
    return df.where(F.col(FLAG))


def with_flag_default(df: DataFrame) -> DataFrame:
    """Absent flags become false."""
    return df.withColumn(FLAG, flag_or_false())


def _chosen(column: str, values: Sequence[str | None]) -> Column:
    """Membership in which None among the values stands for rows without one."""
    known = [v for v in values if v is not None]
    condition = F.col(column).isin(known) if known else F.lit(False)
    return condition | F.col(column).isNull() if None in values else condition


def facet_filter(
    df: DataFrame,
    *,
    status: Sequence[str | None] | None = None,
    location: Sequence[str | None] | None = None,
    card_type: Sequence[str | None] | None = None,
) -> DataFrame:
    """Rows matching every given choice.

    ``None`` for a facet keeps all its rows; an empty choice keeps none.
    """
    for column, values in zip(FACETS, (status, location, card_type), strict=True):
        if values is not None:
            df = df.where(_chosen(column, values))
    return df


def facet_values(df: DataFrame, facets: Sequence[str] = FACETS) -> DataFrame:
    """The distinct values of each facet, a missing value included, in order.

    One pass: rows shrink to their distinct combinations before they are unpivoted.
    """
    return (
        df.select(*facets)
        .distinct()
        .unpivot([], list(facets), "facet", "value")
        .distinct()
        .orderBy("facet", "value")
    )


def period_filter(df: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """Rows from the day ``since`` on and before the day ``until``; a bound that isn't given keeps all."""
    if since is not None:
        df = df.where(F.col("timestamp") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        df = df.where(F.col("timestamp") < F.lit(until).cast("timestamp_ntz"))
    return df
