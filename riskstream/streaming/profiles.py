"""Profiles that a batch job writes and a stream looks up.

``<path>/as_of=2025-01-31`` holds what was known at the start of a day. Each micro-batch lists the folders anew and takes, for
each transaction, the newest profiles that are not after its day, so a running stream picks up newer ones.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskstream import files
from riskstream.operators import patterns, risk
from riskstream.streaming.log import BatchWriter, job_id

CUSTOMERS, MERCHANTS, HOURS = "customers", "merchants", "hours"


def write_profiles(df: DataFrame, path: str, day: date, failed: str = "FAILED") -> None:
    """Write what the transactions before a day say of customers and merchants. A folder that is there is replaced."""
    at = F.lit(day)
    made = {
        CUSTOMERS: risk.profiles_of(df, "customer_id", at, failed),
        MERCHANTS: risk.profiles_of(df, "merchant", at, failed),
        HOURS: patterns.hour_profiles(df.where(F.col("timestamp") < at)),
    }
    for name, rows in made.items():
        rows.drop("as_of").write.mode("overwrite").parquet(f"{path}/{name}/as_of={day}")


def days(spark: SparkSession, path: str, name: str) -> list[date]:
    """The days there are profiles of."""
    found = (part.partition("=") for part in files.names(spark, f"{path}/{name}"))
    return sorted(date.fromisoformat(value) for key, _, value in found if key == "as_of")


def newest(known: list[date], day: Column) -> Column:
    """The last of some days that isn't after ``day``; null if all are."""
    out = F.lit(None).cast("date")
    for d in known:
        out = F.when(day >= F.lit(d), F.lit(d)).otherwise(out)
    return out


def read_profiles(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}")


def with_risk(rows: DataFrame, path: str, model: PipelineModel) -> DataFrame:
    """Transactions with ``risk``, by the profiles in a folder. One without a day is left out."""
    spark = rows.sparkSession
    known = days(spark, path, CUSTOMERS)
    dated = risk.with_day(rows).where(F.col("day").isNotNull())
    asked = dated.withColumn("as_of", newest(known, F.col("day")))
    found = risk.features(asked, read_profiles(spark, path, CUSTOMERS), read_profiles(spark, path, MERCHANTS))
    return risk.score(found, model)


def at_unusual_hours(rows: DataFrame, path: str, below: float = 0.02, seen: int = 50) -> DataFrame:
    """Transactions at an hour at which their customer is hardly ever seen, by the profiles in a folder."""
    spark = rows.sparkSession
    asked = risk.with_day(rows).withColumn("as_of", newest(days(spark, path, HOURS), F.col("day")))
    return patterns.at_unusual_hours(asked, read_profiles(spark, path, HOURS), below, seen)


def judged_writer(path: str, checkpoint: str, judge: Callable[[DataFrame], DataFrame]) -> BatchWriter:
    """Writes what ``judge`` makes of a batch to a folder of its job that a replay overwrites."""

    def write(batch: DataFrame, batch_id: int) -> None:
        job = job_id(batch.sparkSession, checkpoint)
        judge(batch).write.mode("overwrite").parquet(f"{path}/job={job}/batch_id={batch_id}")

    return write
