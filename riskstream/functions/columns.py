"""Column expressions shared by batch and streaming code. All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from riskstream.schema import FIRST_YEAR, FLAG, KEY, LAST_YEAR


def usable_amount(amount: str = "amount") -> Column:
    """The amount, with NaN turned into null so that averages skip it."""
    return F.when(~F.isnan(amount), F.col(amount))


def over_threshold(threshold: float, amount: str = "amount") -> Column:
    """True for an amount strictly above the threshold; false for null or NaN.

    A conjunction rather than a ``coalesce``: never null, yet as a filter it
    falls apart into conditions the Parquet scan can use.
    """
    value = F.col(amount)
    return value.isNotNull() & (value > F.lit(float(threshold))) & ~F.isnan(value)


def flag_or_false(flag: str = FLAG) -> Column:
    """The stored flag, where absent means false."""
    return F.coalesce(F.col(flag), F.lit(False))


def period_start(grain: str, timestamp: str = "timestamp") -> Column:
    """First day of the calendar month, or the day itself, as a date.

    Works on dates, so the session time zone plays no part.
    """
    day = F.col(timestamp).cast("date")
    if grain == "day":
        return day
    if grain == "month":
        return F.trunc(day, "month")
    raise ValueError(f"unknown grain: {grain!r} (use 'month' or 'day')")


def month_label(day: str | Column) -> Column:
    """A label like ``Jan 2025``."""
    return F.date_format(day, "MMM yyyy")


def iso_text(timestamp: str = "timestamp") -> Column:
    """ISO-8601 text without zone, keeping microseconds where there are any."""
    return F.translate(F.col(timestamp).cast("string"), " ", "T")


def readable_timestamp(text: str = "timestamp") -> Column:
    """Timestamp of any year from text holding at least a full date; null when it is none."""
    full_date = F.col(text).rlike(r"^\s*\d{4,6}-\d{1,2}-\d{1,2}")
    return F.when(full_date, F.col(text).try_cast("timestamp_ntz"))


def of_accepted_year(found: Column) -> Column:
    """The timestamp, null when its year is not an accepted one."""
    return F.when(F.year(found).between(FIRST_YEAR, LAST_YEAR), found)


def parsed_timestamp(text: str = "timestamp") -> Column:
    """The readable timestamp, null too when its year is not an accepted one."""
    return of_accepted_year(readable_timestamp(text))


def id_order(key: str = KEY, *, descending: bool = False) -> list[Column]:
    """Sort columns for an id: short before long, then as text.

    Numeric for ids made of digits, and total for any other kind of text.
    """
    columns = [F.length(key), F.col(key)]
    return [c.desc() for c in columns] if descending else [c.asc() for c in columns]


def sample_order(seed: int, key: str = KEY) -> Column:
    """A fixed pseudo-random order of the ids, different for every seed."""
    return F.md5(F.concat(F.coalesce(F.col(key), F.lit("")), F.lit(f":{seed}")))
