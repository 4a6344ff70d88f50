"""Conflict rules of the table: insert-ignore and flag-upsert.

Both rules keep the first row of a key. Insert-ignore keeps it whole;
flag-upsert takes the flag from the last row. Each is a single aggregation whose
partial step runs before the shuffle, so a key with very many deliveries leaves
one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskstream.schema import FLAG, KEY

ARRIVAL = ("written_at", "job", "batch_id", "position")


def _order(columns: Sequence[str]) -> Column:
    return F.struct(*columns) if len(columns) > 1 else F.col(columns[0])


def _others(df: DataFrame, *left_out: str) -> list[str]:
    return [c for c in df.columns if c not in left_out]


def insert_ignore(
    df: DataFrame, order: Sequence[str] = ARRIVAL, key: str = KEY
) -> DataFrame:
    """The first row of each key, nulls and all."""
    kept = _others(df, *order)
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min_by(F.struct(*kept), _order(order)).alias("first"))
        .select("first.*")
    )


def flag_upsert(df: DataFrame, order: Sequence[str] = ARRIVAL, key: str = KEY) -> DataFrame:
    """The first row of each key with the flag of its last row."""
    kept = _others(df, FLAG, *order)
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(
            F.min_by(F.struct(*kept), _order(order)).alias("first"),
            F.max_by(FLAG, _order(order)).alias(FLAG),
        )
        .select("first.*", FLAG)
    )


RULES = {"insert_ignore": insert_ignore, "flag_upsert": flag_upsert}


def _new_rows(table: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows of the batch whose key the table lacks."""
    known = table.select(key).join(batch.select(key), key, "left_semi")
    return batch.join(known, key, "left_anti").select(*table.columns)


def insert_ignore_into(table: DataFrame, batch: DataFrame, key: str = KEY) -> DataFrame:
    """The table after inserting the rows of ``batch`` whose key it lacks.

    Both sides hold a key at most once. The table is only ever the left side of a
    join, so a batch small enough to broadcast is merged without shuffling the table.
    The batch is read several times: store it first if it is costly.
    """
    return table.unionByName(_new_rows(table, batch, key))


def flag_upsert_into(table: DataFrame, batch: DataFrame, key: str = KEY) -> DataFrame:
    """The table after inserting new keys and setting the flag of known ones.

    Joined like :func:`insert_ignore_into`.
    """
    flags = batch.select(key, F.struct(FLAG).alias("new"))
    flag = F.when(F.col("new").isNotNull(), F.col(f"new.{FLAG}")).otherwise(F.col(FLAG))
    updated = table.join(flags, key, "left").withColumn(FLAG, flag).select(*table.columns)
    return updated.unionByName(_new_rows(table, batch, key))


MERGES = {"insert_ignore": insert_ignore_into, "flag_upsert": flag_upsert_into}


#: Where the row that a key's values are from, and the one its flag is from, stand in the order of arrival.
ARRIVED, FLAGGED = "arrived", "flagged_at"


def ordered(df: DataFrame, rule: str, order: Sequence[str] = ARRIVAL, key: str = KEY) -> DataFrame:
    """The rows of a rule, with the places in the order that decided them.

    A place goes in front of what it decides, so that each is sorted and shuffled once.
    """
    kept = _others(df, FLAG, *order)
    place = F.struct(*order)
    first, flagged = F.struct(place.alias(ARRIVED), *kept), F.struct(place.alias(FLAGGED), FLAG)
    if rule == "flag_upsert":
        wanted = [F.min(first).alias("first"), F.max(flagged).alias("flagged")]
    else:  # all of one row
        wanted = [F.min(F.struct(first.alias("first"), F.col(FLAG))).alias("whole")]
    found = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(*wanted)
    if rule != "flag_upsert":
        found = found.select("whole.first", F.struct(F.col(f"whole.first.{ARRIVED}").alias(FLAGGED), f"whole.{FLAG}").alias("flagged"))
    return found.select("first.*", "flagged.*").select(*kept, FLAG, ARRIVED, FLAGGED)


def combined(rows: DataFrame, rule: str, key: str = KEY) -> DataFrame:
    """One row for each key of rows that have such places: their order decides, however often a row is there."""
    values = [c for c in rows.columns if c not in (key, FLAG, FLAGGED, ARRIVED)]
    by_flag = F.max if rule == "flag_upsert" else F.min
    return (
        rows.groupBy(key)
        .agg(
            F.min(F.struct(ARRIVED, *values)).alias("first"),
            by_flag(F.struct(FLAGGED, FLAG)).alias("flagged"),
        )
        .select(key, "first.*", "flagged.*")
        .select(*rows.columns)
    )


def merge_ordered(table: DataFrame, batch: DataFrame, rule: str, key: str = KEY) -> DataFrame:
    """Two tables of :func:`ordered` as one, whichever came first and however often rows come again.

    The place a row has decides, not the side it is on: a batch that is merged twice, or later than
    one that arrived after it, changes nothing. Only rows whose key is in the batch are grouped; the table is
    the left side of all joins, so a batch small enough to broadcast is merged without shuffling the table.
    """
    keys = batch.select(key)
    known = table.join(keys, key, "left_semi")
    others = table.join(keys, key, "left_anti")
    return others.unionByName(combined(known.unionByName(batch), rule, key)).select(*table.columns)


def dedup_within(df: DataFrame, delay: str, key: str = KEY) -> DataFrame:
    """Streaming insert-ignore that remembers a key for ``delay`` only.

    For sinks that cannot hold duplicates at all. State is bounded, but a copy
    arriving later than ``delay`` passes, and which of several copies in one
    micro-batch stays is open. The log keeps neither limit.
    """
    return df.withWatermark("delivered_at", delay).dropDuplicatesWithinWatermark([key])
