"""The delivery log: every message, in folders that a replay overwrites.

``<log>/job=ID/batch_id=N/outcome=stored|rejected``. A batch that runs again after
a failure writes the same folder again, which makes at-least-once delivery
idempotent without a table format. Batches are numbered from 0 for each checkpoint, so the
id that Spark keeps with a checkpoint is the first level: several jobs, or a job with a
new checkpoint, fill one log side by side.

The table itself is the log resolved by a conflict rule, in the order of the batches' times. A
batch's time is the one that Spark notes in the checkpoint before the batch runs: a batch that runs again finds it
there, so a replay changes neither a row nor its place, whatever other jobs have written meanwhile.

``<log>/_batches/ID/N.json`` is written once a batch is complete: its time and counts. These
entries are the manifest of the log, by which a merge reads only the batches it lacks.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from riskstream import files
from riskstream.functions import of_accepted_year, readable_timestamp
from riskstream.operators.decode import decode, with_flag
from riskstream.operators.upsert import ARRIVAL, RULES, merge_ordered, ordered
from riskstream.operators.validate import with_reason
from riskstream.schema import DEFAULT_THRESHOLD, FLAG, LOG_SCHEMA, MERGED_SCHEMA, STORED_COLUMNS
from riskstream.session import stored
from riskstream.sources.messages import with_offsets

logger = logging.getLogger(__name__)

STORED, REJECTED = "stored", "rejected"
BatchWriter = Callable[[DataFrame, int], None]


def log_rows(messages: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Messages as rows of the log: decoded, flagged, and checked.

    The raw text is kept for rejected rows only.
    """
    return checked_rows(with_reason(with_flag(decode(messages), threshold)))


def checked_rows(checked: DataFrame) -> DataFrame:
    """Messages that are decoded, flagged and checked as rows of the log."""
    accepted = F.col("reason").isNull()
    return checked.withColumn("_found", readable_timestamp()).withColumns({
        "timestamp": of_accepted_year(F.col("_found")),
        "raw": F.when(~accepted, F.col("raw")),
        "outcome": F.when(accepted, STORED).otherwise(REJECTED),
    }).select(*STORED_COLUMNS, "position", "reason", "raw", "outcome")


def job_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps with its checkpoint, through all restarts."""
    return json.loads(files.read_text(spark, f"{checkpoint}/metadata"))["id"]


def _entry(path: str, job: str, batch_id: int) -> str:
    return f"{path}/_batches/{job}/{batch_id}.json"


def batch_time(spark: SparkSession, path: str, checkpoint: str, batch_id: int) -> int:
    """The batch's time in microseconds: that in the checkpoint, and never before that of the job's batch before."""
    noted = json.loads(files.read_text(spark, f"{checkpoint}/offsets/{batch_id}").split("\n")[1])
    time, before = noted["batchTimestampMs"] * 1000, _entry(path, job_id(spark, checkpoint), batch_id - 1)
    if files.exists(spark, before):
        time = max(time, json.loads(files.read_text(spark, before))["written_at"])
    return time


def log_writer(path: str, checkpoint: str) -> BatchWriter:
    """Writes one batch of log rows, evaluating it once, from the executors.

    The numbers of rows, suspicious rows and rejects are observed on the way and noted in the batch's entry.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = Observation(f"batch {batch_id}")
        job, time = job_id(spark, checkpoint), batch_time(spark, path, checkpoint, batch_id)
        (
            with_offsets(batch)
            .withColumn("written_at", F.timestamp_micros(F.lit(time).cast("long")))
            .observe(
                seen,
                F.count(F.lit(1)).alias("total"),
                F.count_if(FLAG).alias("suspicious"),
                F.count_if(F.col("outcome") == REJECTED).alias("rejected"),
            )
            .write.mode("overwrite")
            # The whole folder, whatever the session does with partitions.
            .option("partitionOverwriteMode", "static")
            .partitionBy("outcome")
            .parquet(f"{path}/job={job}/batch_id={batch_id}")
        )
        entry = {"job": job, "batch_id": batch_id, "written_at": time, **seen.get}
        files.write_once(spark, _entry(path, job, batch_id), json.dumps(entry))
        logger.info("batch %d: %s", batch_id, seen.get)

    return write


def read_log(spark: SparkSession, path: str, outcome: str | None = None) -> DataFrame:
    """The log, or the part of it with one outcome."""
    rows = spark.read.schema(LOG_SCHEMA).option("basePath", path).parquet(path)
    return rows if outcome is None else rows.where(F.col("outcome") == outcome)


def batch_counts(log: DataFrame, by: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """Rows, suspicious rows and rejects of each batch; by ``("job", "batch_id")`` where jobs share the log."""
    return log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(FLAG).alias("suspicious"),
        F.count_if(F.col("outcome") == REJECTED).alias("rejected"),
    )


def resolved(log: DataFrame, rule: str, order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """The table that a log stands for: one row per transaction id.

    Rows count as arriving in the order in which their batches were written, then by
    position. Give ``order=("position",)`` where positions alone are the order of arrival.
    """
    accepted = log.where(F.col("outcome") == STORED)
    return RULES[rule](accepted.select(*STORED_COLUMNS, *order), order)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(job, batch_id, written_at, total, suspicious, rejected) of the complete batches, without reading them."""
    schema = "job string, batch_id long, written_at long, total long, suspicious long, rejected long"
    folders = [f"{path}/_batches/{job}" for job in files.names(spark, f"{path}/_batches")]
    if not folders:
        return spark.createDataFrame([], schema).withColumn("written_at", F.timestamp_micros("written_at"))
    return spark.read.schema(schema).json(folders).withColumn("written_at", F.timestamp_micros("written_at"))


def batches(spark: SparkSession, path: str) -> set[tuple[str, int]]:
    """(job, batch_id) of the complete batches, from the names of their entries."""
    found = ((job, name) for job in files.names(spark, f"{path}/_batches") for name in files.names(spark, f"{path}/_batches/{job}"))
    return {(job, int(name.removesuffix(".json"))) for job, name in found}


def held(spark: SparkSession, table_path: str) -> set[tuple[str, int]]:
    """(job, batch_id) of the batches that a merged table holds."""
    record = _record(table_path)
    if not files.exists(spark, record):
        return set()
    rows = spark.read.schema("job string, batch_id long").parquet(record).distinct()
    return {(row.job, row.batch_id) for row in rows.toLocalIterator()}


def hold(spark: SparkSession, table_path: str, taken: set[tuple[str, int]]) -> None:
    """Note that a merged table holds some more batches."""
    rows = spark.createDataFrame(sorted(taken), "job string, batch_id long")
    rows.coalesce(1).write.mode("append").parquet(_record(table_path))


def _record(table_path: str) -> str:
    return f"{table_path.rstrip('/')}.batches"


def read_batches(spark: SparkSession, log_path: str, wanted: set[tuple[str, int]]) -> DataFrame:
    """The rows of some batches; no other folder is looked at."""
    folders = [f"{log_path}/job={job}/batch_id={n}" for job, n in sorted(wanted)]
    reader = spark.read.schema(LOG_SCHEMA).option("basePath", log_path)
    # a batch without rows has no folder for its outcomes
    return reader.parquet(*folders) if folders else spark.createDataFrame([], LOG_SCHEMA)


def lacking(spark: SparkSession, log_path: str, table_path: str | None, through_batch: int | None = None) -> set[tuple[str, int]]:
    """The complete batches that a merged table doesn't hold."""
    there = {(job, n) for job, n in batches(spark, log_path) if through_batch is None or n <= through_batch}
    return there - held(spark, table_path) if table_path is not None else there


def reduced(spark: SparkSession, log_path: str, rule: str, wanted: set[tuple[str, int]]) -> DataFrame:
    """Some batches reduced to one row an id, with its places in the order of arrival."""
    rows = read_batches(spark, log_path, wanted).where(F.col("outcome") == STORED)
    return ordered(rows.select(*STORED_COLUMNS, *ARRIVAL), rule)


def merged_table(spark: SparkSession, path: str) -> DataFrame:
    """A merged table with its places in the order of arrival. Without them, read it like any stored table."""
    return spark.read.schema(MERGED_SCHEMA).parquet(path).select(*MERGED_SCHEMA.names)


def current_table(
    spark: SparkSession,
    log_path: str,
    rule: str,
    *,
    base_path: str | None = None,
    through_batch: int | None = None,
) -> DataFrame:
    """The table as of ``through_batch`` of each job, or of the last batches.

    With ``base_path``, a merged table, only the batches that it doesn't hold are read and
    merged into it. They are reduced and stored first, so that the planner knows their
    size and, if it is small, leaves the base where it is.
    """
    wanted = lacking(spark, log_path, base_path, through_batch)
    return _current(spark, log_path, rule, base_path, wanted).select(*STORED_COLUMNS)


def _current(spark: SparkSession, log_path: str, rule: str, base_path: str | None, wanted: set[tuple[str, int]]) -> DataFrame:
    rows = reduced(spark, log_path, rule, wanted)
    if base_path is None:
        return rows
    return merge_ordered(merged_table(spark, base_path), stored(rows, "tail"), rule)


def compact(
    spark: SparkSession,
    log_path: str,
    rule: str,
    out_path: str,
    *,
    base_path: str | None = None,
    through_batch: int | None = None,
) -> DataFrame:
    """Write :func:`current_table` to the new folder ``out_path``, and next to it which batches it holds.

    Nothing is changed in place: point the table's view or location at the new folder
    once this returns. Batches may be left out and merged later, in any order. For a table that is kept up to
    date month by month, see :mod:`riskstream.streaming.monthly`.
    """
    wanted = lacking(spark, log_path, base_path, through_batch)
    before = set() if base_path is None else held(spark, base_path)
    _current(spark, log_path, rule, base_path, wanted).write.parquet(out_path)
    hold(spark, out_path, wanted | before)
    return merged_table(spark, out_path).select(*STORED_COLUMNS)


def prune(spark: SparkSession, log_path: str, table_path: str) -> int:
    """Remove the log's batches that a merged table holds; returns how many there were.

    The table then is the only place they are kept in: merge further with it as the base. The
    batches' entries stay.
    """
    gone = 0
    for job, n in held(spark, table_path):
        folder = f"{log_path}/job={job}/batch_id={n}"
        if files.exists(spark, folder):
            files.remove(spark, folder)
            gone += 1
    return gone
