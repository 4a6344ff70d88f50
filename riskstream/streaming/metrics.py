"""Counts of each batch as it runs, written down by a listener: no stored row is read for them."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from riskstream import files
from riskstream.schema import FLAG

#: The name under which batches are observed.
OBSERVED = "batch"
COUNTS = ("total", "suspicious", "rejected")


def observed(rows: DataFrame) -> DataFrame:
    """Log rows, counted on their way through."""
    return rows.observe(
        OBSERVED,
        F.count(F.lit(1)).alias("total"),
        F.count_if(FLAG).alias("suspicious"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
    )


class BatchMetrics(StreamingQueryListener):
    """Writes ``<path>/ID/N.json`` once batch N of the query with that id is through: its counts and how long it took.

    A batch that runs again after a failure is written once. Register it with ``spark.streams.addListener``; it
    listens to all queries whose rows are :func:`observed`.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get(OBSERVED)
        if counts is None:
            return
        entry = {"job": str(progress.id), "batch_id": progress.batchId, **{c: counts[c] for c in COUNTS}, "took_ms": progress.batchDuration}
        files.write_once(self._spark, f"{self._path}/{entry['job']}/{entry['batch_id']}.json", json.dumps(entry))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(job, batch_id, total, suspicious, rejected, took_ms) of the batches so far."""
    schema = "job string, batch_id long, total long, suspicious long, rejected long, took_ms long"
    folders = [f"{path}/{job}" for job in files.names(spark, path)]
    return spark.read.schema(schema).json(folders) if folders else spark.createDataFrame([], schema)
