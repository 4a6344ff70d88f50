"""Additive measures, and the summary that holds them per group.

Counts, sums and averages over transactions can be had from rows or from a
summary of them. Every operator in ``breakdown``, ``trends`` and the counting
part of ``locations`` takes either: it reads the columns below, which
:func:`measured` adds to plain rows and a summary already has.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from riskstream.functions import flag_or_false, period_start, usable_amount
from riskstream.schema import FACETS, FLAG

ROWS, AMOUNT, AMOUNTS = "row_count", "amount_sum", "amount_count"
#: A KLL sketch of the amounts, in summaries that are asked for one.
SKETCH = "amount_sketch"


def is_summary(df: DataFrame) -> bool:
    return ROWS in df.columns


def measured(df: DataFrame) -> DataFrame:
    """Rows with their measures: 1, the amount, and 1 if there is an amount."""
    if is_summary(df):
        return df
    measures = {ROWS: F.lit(1).cast("long")}
    if FLAG in df.columns:
        measures[FLAG] = flag_or_false()
    if "amount" in df.columns:
        measures[AMOUNT] = usable_amount()
        measures[AMOUNTS] = usable_amount().isNotNull().cast("long")
    return df.withColumns(measures)


def summary(
    df: DataFrame, facets: Iterable[str] = FACETS, grain: str = "day", sketch: int | None = None
) -> DataFrame:
    """One row per period, facet values and flag, with the measures.

    A single pass over the table, combined in each task before the shuffle; its
    size depends on the number of distinct groups only. Everything additive can
    then be answered without reading the table again. With ``sketch``, the size of one, each row also has a sketch of its
    amounts, from which approximate quantiles of any groups can be had. A summary by day may be given in place of the rows.
    """
    periods = df.withColumn("timestamp", period_start(grain).cast("timestamp_ntz"))
    measures = [F.sum(c).alias(c) for c in (ROWS, AMOUNT, AMOUNTS)]
    if sketch is not None:
        merged = F.kll_merge_agg_double(SKETCH) if SKETCH in df.columns else F.kll_sketch_agg_double(usable_amount(), sketch)
        measures.append(merged.alias(SKETCH))
    return measured(periods).groupBy("timestamp", *facets, FLAG).agg(*measures)


def total(measure: str, condition: str | None = None):
    """Sum of a measure, optionally of the rows where ``condition`` holds; 0 if none."""
    value = F.when(F.col(condition), F.col(measure)) if condition else F.col(measure)
    return F.coalesce(F.sum(value), F.lit(0))


def average():
    """Mean amount; null where there is no amount."""
    return F.try_divide(F.sum(AMOUNT), F.sum(AMOUNTS))
