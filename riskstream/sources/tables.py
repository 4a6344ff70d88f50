"""Stored transaction tables: Parquet folders and JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskstream.options import JobOptions
from riskstream.schema import STORED_SCHEMA


def parquet_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table, or one merged by month; only the columns and row groups a query needs are read."""
    return spark.read.schema(STORED_SCHEMA).parquet(path).select(*STORED_SCHEMA.names)


def jdbc_settings(options: JobOptions) -> dict[str, str]:
    settings = {"url": options.jdbc_url, "fetchsize": "10000"}
    if options.db_user:
        settings["user"] = options.db_user
    if options.db_password:
        settings["password"] = options.db_password
    return settings


def bounds_query(table: str, column: str) -> str:
    return f"SELECT min({column}) AS lower, max({column}) AS upper FROM {table}"


def jdbc_ranges(column: str, lower: str, upper: str, partitions: int) -> dict[str, str]:
    """Settings that have many tasks read ranges of ``column`` between its bounds."""
    return {
        "partitionColumn": column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(partitions),
    }


def jdbc_table(
    spark: SparkSession, options: JobOptions, *, column: str = "timestamp", partitions: int = 64
) -> DataFrame:
    """The table in a database, read by many tasks over ranges of ``column``.

    The database is asked for the bounds first. Filters and the column list are sent to it.
    Needs the JDBC driver.
    """
    reader = spark.read.format("jdbc").option("preferTimestampNTZ", "true").options(**jdbc_settings(options))
    ends = reader.option("query", bounds_query(options.db_table, column)).load().first()
    reader = spark.read.format("jdbc").option("preferTimestampNTZ", "true").options(**jdbc_settings(options))
    if ends is not None and ends[0] is not None:
        reader = reader.options(**jdbc_ranges(column, str(ends[0]), str(ends[1]), partitions))
    return reader.option("dbtable", options.db_table).load().select(*STORED_SCHEMA.names)
