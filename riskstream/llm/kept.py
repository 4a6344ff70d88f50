"""Columns that an operator carries along, whatever their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROW = "__row"


def carried(keep: list[str], results: list[str]) -> tuple[list[str], Column]:
    """The columns to keep, without those that have the name of a result, and a struct that holds them."""
    kept = [c for c in keep if c not in results]
    fields = [F.col(f"`{c}`").alias(c) for c in kept] or [F.lit(None).cast("int").alias("none")]
    return kept, F.struct(*fields).alias(ROW)


def restored(df: DataFrame, kept: list[str], results: list[str]) -> DataFrame:
    """The kept columns out of their struct, next to the results."""
    return df.select(*(F.col(ROW)[c].alias(c) for c in kept), *results)
