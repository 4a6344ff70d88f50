"""The merged table by month, of which a merge rewrites only the months it touches.

``<table>/month=2025-01`` holds the transactions of a month with their places in the order of arrival, and
``<table>.keys/month=2025-01`` their ids: the index that says in which months the ids of a new batch
are already. ``<table>.summary/month=2025-01`` is the summary of the month's transactions, for
all additive figures. A merge reads the log's new batches, looks their ids up in the index, and replaces
these months and those of the new rows by dynamic partition overwrite. All other months' files stay. Index
and summary are made from the rows just merged: the table isn't read for them. The first rows of a table are written by month
at once, without a copy of them, and index and summary made from what was written; months that are new have no rows to merge with.

A merge that fails can be run again at any point: months first, then index and summary, then the record of the batches. Until a batch is
recorded it is merged again, which changes nothing, as the places in the order of arrival decide (see ``merge_ordered``). One merge runs at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskstream import files
from riskstream.operators.measures import summary
from riskstream.operators.upsert import merge_ordered
from riskstream.schema import KEY, MERGED_SCHEMA
from riskstream.session import stored
from riskstream.streaming import log

MONTH = "month"
#: The size of the sketches of amounts in the summary.
SKETCH = 256


def _with_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn(MONTH, F.date_format("timestamp", "yyyy-MM"))


def _keys(table_path: str) -> str:
    return f"{table_path.rstrip('/')}.keys"


def _summaries(table_path: str) -> str:
    return f"{table_path.rstrip('/')}.summary"


def has_summary(spark: SparkSession, table_path: str) -> bool:
    """Whether a folder is a table by month with a summary."""
    return files.exists(spark, _summaries(table_path))


def merged_summary(spark: SparkSession, table_path: str) -> DataFrame:
    """The summary of the table by day, facets and flag: give it to the additive operators in place of the rows."""
    return spark.read.parquet(_summaries(table_path)).drop(MONTH)


def _by_month(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(StructType([*MERGED_SCHEMA, StructField(MONTH, StringType())])).parquet(path)


def _read(spark: SparkSession, path: str, months: list[str]) -> DataFrame:
    """The rows of some months; only their folders are read."""
    return _by_month(spark, path).where(F.col(MONTH).isin(months)).drop(MONTH)


def _there(spark: SparkSession, table_path: str) -> list[str]:
    """The months that the table has."""
    return [name.removeprefix(f"{MONTH}=") for name in files.names(spark, table_path) if name.startswith(f"{MONTH}=")]


def months_of(spark: SparkSession, table_path: str, rows: DataFrame) -> list[str]:
    """The months that rows belong to by their own time or by where their ids are already; at most as many as there are years of twelve."""
    found = _with_month(rows).select(MONTH)
    path = _keys(table_path)
    if files.exists(spark, path):
        index = spark.read.schema(f"{KEY} string, {MONTH} string").parquet(path)
        found = found.unionByName(index.join(rows.select(KEY), KEY, "left_semi").select(MONTH))
    return sorted(row[0] for row in found.distinct().collect())


def _replace(rows: DataFrame, path: str) -> None:
    """Replace the months that rows are of. A month goes to as many files as its size asks for."""
    rows.hint("rebalance", MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def merge_batches(spark: SparkSession, log_path: str, rule: str, table_path: str, through_batch: int | None = None) -> list[str]:
    """Merge the batches that the table lacks into it; returns the months that were rewritten."""
    wanted = log.lacking(spark, log_path, table_path, through_batch)
    if not wanted:
        return []
    new, there = log.reduced(spark, log_path, rule, wanted), _there(spark, table_path)
    months = _merge(spark, new, rule, table_path, there) if there else _begin(spark, new, table_path)
    log.hold(spark, table_path, wanted)
    return months


def _begin(spark: SparkSession, new: DataFrame, table_path: str) -> list[str]:
    """The first rows: there is nothing to look up or to merge with, so they go straight to their months."""
    _replace(_with_month(new), table_path)
    months = _there(spark, table_path)
    if months:
        _describe(_by_month(spark, table_path), table_path)
    return months


def _merge(spark: SparkSession, rows: DataFrame, rule: str, table_path: str, there: list[str]) -> list[str]:
    new = stored(rows, "tail")
    months = months_of(spark, table_path, new)
    if months:
        once, old = _with_month(new), [month for month in months if month in there]
        if old:
            once = stored(_with_month(merge_ordered(_read(spark, table_path, old), new, rule)), "months")
        _replace(once, table_path)
        _describe(once, table_path)
        _drop_emptied(spark, once, months, table_path)
    return months


def _describe(rows: DataFrame, table_path: str) -> None:
    """Replace index and summary of the months that rows are of."""
    _replace(rows.select(KEY, MONTH), _keys(table_path))
    _replace(_with_month(summary(rows, grain="day", sketch=SKETCH)), _summaries(table_path))


def _drop_emptied(spark: SparkSession, rows: DataFrame, months: list[str], table_path: str) -> None:
    """Remove the months whose last row has moved to another month, which nothing replaces."""
    left = {row[0] for row in rows.select(MONTH).distinct().collect()}
    for month in set(months) - left:
        for path in (table_path, _keys(table_path), _summaries(table_path)):
            files.remove(spark, f"{path}/{MONTH}={month}")
