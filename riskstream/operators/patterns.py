"""Unusual behaviour of customers and merchants. The definitions are this library's own.

Everything is counted per customer or merchant, combined in each task before the shuffle, so a
customer with very many transactions leaves few rows. What counts in windows of time works on a
stream as well: give ``watermark``, and windows close that long after the last event time seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from riskstream.operators.measures import ROWS, measured, total
from riskstream.schema import FLAG


def frequent(
    df: DataFrame, at_least: int, within: str = "1 hour", *, kind: Column | None = None, watermark: str | None = None
) -> DataFrame:
    """Windows of time in which a customer has ``at_least`` transactions (of a kind, if given).

    Watermarks need times with a zone: a stream's are taken in the session's, UTC as
    ``build_session`` has it.
    """
    rows = df if kind is None else df.where(kind)
    rows = rows.where(F.col("customer_id").isNotNull() & F.col("timestamp").isNotNull())
    if watermark is not None:
        rows = rows.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", watermark)
    counted = rows.groupBy("customer_id", F.window("timestamp", within).alias("span")).agg(F.count(F.lit(1)).alias("transactions"))
    found = counted.where(F.col("transactions") >= at_least)
    return found.select("customer_id", *(F.col(f"span.{side}").cast("timestamp_ntz").alias(name) for side, name in (("start", "since"), ("end", "until"))), "transactions")


def repeated_failures(df: DataFrame, at_least: int = 3, within: str = "1 hour", *, failed: str = "FAILED", watermark: str | None = None) -> DataFrame:
    """Windows of time in which ``at_least`` transactions of a customer failed."""
    return frequent(df, at_least, within, kind=F.col("status") == failed, watermark=watermark)


def failure_bursts(df: DataFrame, at_least: int = 3, within: str = "1 hour", *, failed: str = "FAILED", watermark: str | None = None) -> DataFrame:
    """Failed transactions of a customer that are at least the ``at_least``-th in less than ``within``."""
    return bursts(df, at_least, within, kind=F.col("status") == failed, watermark=watermark)


def _seconds(span: str) -> int:
    number, unit = span.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def bursts(
    df: DataFrame, at_least: int, within: str = "1 hour", *, kind: Column | None = None, watermark: str | None = None
) -> DataFrame:
    """Transactions of a customer that are at least the ``at_least``-th (of a kind, if given) in less than ``within``.

    ``until`` is the time of the transaction, ``since`` of the ``at_least - 1``-th before it. Unlike the
    windows of :func:`frequent`, a span begins anywhere. ``within`` is a number and a unit up to days. Each
    transaction is looked at in the window of twice that length in whose second half it lies, so a customer's transactions
    are split by time.

    On a stream, which needs a ``watermark``, a customer's last ``at_least - 1`` times are held, however many
    transactions there are, and let go once the watermark is ``within`` behind them. A transaction is judged by those that came with it or before it:
    if a customer's come in order of time, that is what the batch finds; one that comes late doesn't change what was found of
    later ones, and is left out if it is behind the watermark.
    """
    seconds = _seconds(within)
    rows = df if kind is None else df.where(kind)
    rows = rows.where(F.col("customer_id").isNotNull() & F.col("timestamp").isNotNull())
    if df.isStreaming:
        found = _bursts_of_stream(rows, at_least, seconds * 1_000_000, watermark or within)
        return found.select("customer_id", *(F.timestamp_micros(c).cast("timestamp_ntz").alias(c) for c in ("since", "until")))
    rows = rows.select("customer_id", F.col("timestamp").cast("timestamp").alias("timestamp"))
    span = F.window("timestamp", f"{2 * seconds} seconds", f"{seconds} seconds").alias("span")
    micros = F.unix_micros("timestamp").alias("until")
    middle = F.unix_micros("span.start") + seconds * 1_000_000
    in_order = Window.partitionBy("customer_id", "span").orderBy("until")
    found = rows.select("customer_id", span, micros).withColumn("since", F.lag("until", at_least - 1).over(in_order))
    found = found.where((F.col("until") >= middle) & (F.col("until") - F.col("since") < seconds * 1_000_000))
    return found.select("customer_id", *(F.timestamp_micros(c).cast("timestamp_ntz").alias(c) for c in ("since", "until")))


def _bursts_of_stream(rows: DataFrame, at_least: int, within: int, watermark: str) -> DataFrame:
    held = at_least - 1
    kind = rows.schema["customer_id"].dataType.simpleString()
    times = rows.select("customer_id", F.col("timestamp").cast("timestamp").alias("timestamp")).withWatermark("timestamp", watermark)
    times = times.select("customer_id", "timestamp", F.unix_micros("timestamp").alias("until"))

    def judge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        known = np.array(state.get[0] if state.exists else [], np.int64)
        for frame in frames:
            until = np.concatenate([known, np.sort(frame["until"].to_numpy())])
            new = np.arange(len(until)) >= len(known)
            order = np.argsort(until, kind="stable")
            until, new = until[order], new[order]
            since = until[: len(until) - held]
            found = new[held:] & (until[held:] - since < within)
            known = until[len(until) - held :] if held <= len(until) else until
            if found.any():
                yield pd.DataFrame({"customer_id": key[0], "since": since[found], "until": until[held:][found]})
        state.update((known.tolist(),))
        if len(known):
            state.setTimeoutTimestamp(max(int(known[-1] + within) // 1000, state.getCurrentWatermarkMs()) + 1)

    return times.groupBy("customer_id").applyInPandasWithState(
        judge, f"customer_id {kind}, since long, until long", "times array<bigint>", "append", GroupStateTimeout.EventTimeTimeout
    )


def unusual_hours(df: DataFrame, below: float = 0.02, seen: int = 50) -> DataFrame:
    """Hours of the day in which a customer with ``seen`` transactions has less than a share ``below`` of them.

    Hours without any are left out: nothing happened in them. A customer has 24 rows at most.
    """
    rows = df.where(F.col("customer_id").isNotNull() & F.col("timestamp").isNotNull())
    counted = rows.groupBy("customer_id", F.hour("timestamp").alias("hour")).agg(F.count(F.lit(1)).alias("transactions"))
    everything = F.sum("transactions").over(Window.partitionBy("customer_id"))
    share = counted.withColumn("of", everything).where(F.col("of") >= seen)
    return share.where(F.col("transactions") < below * F.col("of"))


def hour_profiles(df: DataFrame) -> DataFrame:
    """customer_id, of (all transactions) and hours (how many of them at each hour of the day): a row for each customer."""
    rows = df.where(F.col("customer_id").isNotNull() & F.col("timestamp").isNotNull())
    counted = rows.groupBy("customer_id", F.hour("timestamp").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    # 24 entries at most
    hours = F.map_from_entries(F.collect_list(F.struct("hour", "n"))).alias("hours")
    return counted.groupBy("customer_id").agg(F.sum("n").alias("of"), hours)


def at_unusual_hours(df: DataFrame, profiles: DataFrame, below: float = 0.02, seen: int = 50) -> DataFrame:
    """Transactions at an hour at which their customer, with ``seen`` earlier ones, had less than a share ``below`` of them.

    ``profiles`` are those of :func:`hour_profiles`, and where there are several of a customer, the rows and they have ``as_of`` to tell
    which. Works on a stream: the profiles are a table.
    """
    by = [c for c in ("customer_id", "as_of") if c in profiles.columns]
    there = F.coalesce(F.try_element_at("hours", F.hour("timestamp")), F.lit(0))
    found = df.join(profiles, by).withColumn("transactions", there)
    found = found.where((F.col("of") >= seen) & (F.col("transactions") < below * F.col("of")))
    return found.select(*df.columns, "transactions", "of")


def new_locations(df: DataFrame, known: int = 1) -> DataFrame:
    """When a customer was first seen at a location, for those after the first ``known`` locations.

    Of locations first seen at one time, the first by name counts as the first.
    """
    rows = df.dropna(subset=["customer_id", "location", "timestamp"])
    first = rows.groupBy("customer_id", "location").agg(F.min("timestamp").alias("first_seen"))
    nth = F.row_number().over(Window.partitionBy("customer_id").orderBy("first_seen", "location"))
    return first.withColumn("nth", nth).where(F.col("nth") > known)


MOVE = ("customer_id", "location_before", "since", "location", "until")


def moves(df: DataFrame, within: str | None = None, *, stretch: str = "1 hour", watermark: str | None = None) -> DataFrame:
    """Transactions of a customer at another location than the one before (less than ``within`` ago, if given).

    Those of one time are in order of their locations; rows without a customer, location or time are left out. A
    customer's time line is cut into stretches, which are looked at side by side: the last transaction of
    one is carried over to the first of the next. So a customer with very many transactions is split over tasks,
    and only one row for each stretch of theirs meets in one place.

    On a stream, which needs a ``watermark``, the last transaction of each customer is held, for ``within`` if that is given; the rows of a
    customer must come in order of time to find what the batch finds.
    """
    rows = df.dropna(subset=["customer_id", "location", "timestamp"])
    rows = rows.select("customer_id", "location", F.unix_micros(F.col("timestamp").cast("timestamp")).alias("until"))
    if df.isStreaming:
        found = _moves_of_stream(df.dropna(subset=["customer_id", "location", "timestamp"]), within, watermark or within or "1 hour")
    else:
        found = _moves_of_table(rows, _seconds(stretch) * 1_000_000)
    if within is not None:
        found = found.where(F.col("until") - F.col("since") < _seconds(within) * 1_000_000)
    named = {c: F.timestamp_micros(c).cast("timestamp_ntz").alias(c) for c in ("since", "until")}
    return found.select(*(named.get(c, F.col(c)) for c in MOVE))


def _moves_of_table(rows: DataFrame, length: int) -> DataFrame:
    place = F.struct("until", "location")
    cut = rows.withColumn("stretch", F.floor(F.col("until") / length))
    inside = Window.partitionBy("customer_id", "stretch").orderBy("until", "location")
    before = cut.withColumns({"before": F.lag(place).over(inside), "first": F.row_number().over(inside) == 1})
    # the last transaction of each stretch, and which one was that of the stretch before: rows by stretch only
    last = cut.groupBy("customer_id", "stretch").agg(F.max(place).alias("last"))
    line = Window.partitionBy("customer_id").orderBy("stretch")
    carried = last.select("customer_id", "stretch", F.lag("last").over(line).alias("carried")).where(F.col("carried").isNotNull())
    joined = before.where("first").drop("before").join(carried, ["customer_id", "stretch"]).withColumnRenamed("carried", "before")
    both = before.where("NOT first").unionByName(joined)
    return both.where(F.col("before.location") != F.col("location")).select(
        "customer_id", F.col("before.location").alias("location_before"), F.col("before.until").alias("since"), "location", "until"
    )


def _moves_of_stream(rows: DataFrame, within: str | None, watermark: str) -> DataFrame:
    kind = rows.schema["customer_id"].dataType.simpleString()
    rows = rows.select("customer_id", "location", F.col("timestamp").cast("timestamp").alias("timestamp")).withWatermark("timestamp", watermark)
    rows = rows.select("customer_id", "location", "timestamp", F.unix_micros("timestamp").alias("until"))
    hold = None if within is None else _seconds(within) * 1_000_000

    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get if state.exists else None
        frame = pd.concat(list(frames))[["until", "location"]].sort_values(["until", "location"])
        if last is not None:
            frame = pd.concat([pd.DataFrame([last], columns=["until", "location"]), frame])
        until, location = frame["until"].to_numpy(np.int64), frame["location"].to_numpy()
        moved = np.flatnonzero(location[1:] != location[:-1])
        if len(moved):
            yield pd.DataFrame({
                "customer_id": key[0], "location_before": location[moved], "since": until[moved],
                "location": location[moved + 1], "until": until[moved + 1],
            })
        state.update((int(until[-1]), str(location[-1])))
        if hold is not None:
            state.setTimeoutTimestamp(max(int(until[-1] + hold) // 1000, state.getCurrentWatermarkMs()) + 1)

    timeout = GroupStateTimeout.NoTimeout if hold is None else GroupStateTimeout.EventTimeTimeout
    return rows.groupBy("customer_id").applyInPandasWithState(
        follow, f"customer_id {kind}, location_before string, since long, location string, until long", "until long, location string", "append", timeout
    )


def suspicious_merchants(df: DataFrame, times: float = 1.0, seen: int = 100) -> DataFrame:
    """Merchants with ``seen`` transactions of which a share above ``times`` that of all is suspicious."""
    by_merchant = (
        measured(df)
        .where(F.col("merchant").isNotNull())
        .groupBy("merchant")
        .agg(total(ROWS).alias("transactions"), total(ROWS, FLAG).alias("suspicious"))
    )
    both = by_merchant.agg(F.sum("transactions"), F.sum("suspicious")).first()
    everything, suspicious = (F.lit(n or 0) for n in both)
    # Whole numbers on both sides, so that a merchant at the very share isn't a matter of rounding.
    above = F.col("suspicious") * everything > F.lit(times) * suspicious * F.col("transactions")
    return by_merchant.where(above & (F.col("transactions") >= seen)).select("merchant", "transactions", "suspicious")
