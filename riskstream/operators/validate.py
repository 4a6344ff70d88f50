"""The table's constraints as a dataflow: rows either pass or carry a reason."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from riskstream.functions import of_accepted_year, readable_timestamp
from riskstream.schema import KEY, MAX_LENGTH, REQUIRED


def _reason(problems: Iterable[Column]) -> Column:
    """Comma-separated problems, null when there is none."""
    return F.nullif(F.concat_ws(",", *problems), F.lit(""))


def missing_fields(df: DataFrame, required: Iterable[str] = REQUIRED) -> Column:
    """Names of required fields that are null (or NaN, for floating point)."""
    floating = {name for name, kind in df.dtypes if kind in ("double", "float")}

    def absent(name: str) -> Column:
        null = F.col(name).isNull()
        return null | F.isnan(name) if name in floating else null

    return _reason(F.when(absent(c), F.lit(f"missing:{c}")) for c in required)


def long_fields(limits: Mapping[str, int] = MAX_LENGTH) -> Column:
    """Names of text fields longer than the table allows."""
    return _reason(
        F.when(F.length(c) > limit, F.lit(f"too_long:{c}")) for c, limit in limits.items()
    )


def bad_timestamp(text: str = "timestamp", found: Column | None = None) -> Column:
    """Set when there is a timestamp text that cannot be read, or is of a year that isn't accepted.

    ``found`` is what was read from the text, where that is a column already.
    """
    found = readable_timestamp(text) if found is None else found
    unreadable = F.col(text).isNotNull() & found.isNull()
    far = found.isNotNull() & of_accepted_year(found).isNull()
    return F.when(unreadable, F.lit(f"unreadable:{text}")).when(far, F.lit(f"out_of_range:{text}"))


def with_reason(df: DataFrame) -> DataFrame:
    """Add ``reason``: why the table would refuse the row, or null. The timestamp is read once for all its checks."""
    checks = (missing_fields(df), long_fields(), bad_timestamp(found=F.col("_found")))
    return df.withColumn("_found", readable_timestamp()).withColumn("reason", _reason(checks)).drop("_found")


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows the table accepts, and the rest with their reasons."""
    checked = with_reason(df)
    accepted = checked.where(F.col("reason").isNull()).drop("reason")
    return accepted, checked.where(F.col("reason").isNotNull())


def duplicate_ids(df: DataFrame, key: str = KEY) -> DataFrame:
    """Ids that occur more than once, with their number of rows."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    return counted.where((F.col("copies") > 1) & F.col(key).isNotNull())


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df`` itself, or an error naming the columns it lacks."""
    lacking = [n for n in names if n not in df.columns]
    if lacking:
        raise ValueError(f"missing columns: {', '.join(lacking)}")
    return df
