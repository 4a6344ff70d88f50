"""The streaming job and the backfill job.

Both run the same operators; they differ in where they start, when they stop and
which conflict rule applies. Message sources come from ``riskstream.sources``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from riskstream.operators.decode import decode, with_flag
from riskstream.operators.validate import with_reason
from riskstream.options import JobOptions
from riskstream.schema import STORED_COLUMNS
from riskstream.streaming.log import STORED, BatchWriter, checked_rows, log_rows, log_writer
from riskstream.streaming.metrics import observed
from riskstream.streaming.profiles import judged_writer
from riskstream.streaming.route import file_route_writer, flagged_messages, kafka_route_writer, routed, to_kafka


def _trigger(every: str | None) -> dict[str, object]:
    """What is there now, or a micro-batch every so often."""
    return {"availableNow": True} if every is None else {"processingTime": every}


def start_store(
    messages: DataFrame,
    writer: BatchWriter | str,
    checkpoint: str,
    options: JobOptions = JobOptions(),
    *,
    every: str | None = None,
) -> StreamingQuery:
    """Store all messages. ``writer`` is a batch writer or the path of a log."""
    write = log_writer(writer, checkpoint) if isinstance(writer, str) else writer
    return (
        observed(log_rows(messages, options.threshold))
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def start_route(
    messages: DataFrame,
    path: str | None,
    checkpoint: str,
    options: JobOptions = JobOptions(),
    *,
    whole: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Forward flagged messages to a folder, or to the flagged topic without one."""
    routed = flagged_messages(messages, options.threshold, whole=whole)
    if path is None:
        stream = to_kafka(routed, options)
    else:
        stream = routed.writeStream.foreachBatch(file_route_writer(path, checkpoint))
    return (
        stream.option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def start_fan_out(
    messages: DataFrame,
    writer: BatchWriter | str,
    route_path: str | None,
    checkpoint: str,
    options: JobOptions = JobOptions(),
    *,
    whole: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Store all messages and forward the flagged ones, from one read of the source.

    A batch is read and decoded once and kept until both are written. Each of the two overwrites what an earlier
    run of the batch has written, so the batch may run again at any point; only a topic gets its messages twice then.
    """
    store = log_writer(writer, checkpoint) if isinstance(writer, str) else writer
    forward = kafka_route_writer(options) if route_path is None else file_route_writer(route_path, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            forward(routed(batch, whole=whole), batch_id)
            store(checked_rows(batch), batch_id)
        finally:
            batch.unpersist()

    return (
        observed(with_reason(with_flag(decode(messages), options.threshold)))
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def run_stream(
    spark: SparkSession,
    messages: DataFrame,
    *,
    writer: BatchWriter | str,
    checkpoint: str,
    route_path: str | None = None,
    whole: bool = False,
    options: JobOptions = JobOptions(),
    every: str | None = "10 seconds",
    apart: bool = False,
) -> None:
    """Store and forward until that fails or is done.

    The source is read once for both, unless they are to run ``apart``: as two queries, of which
    neither waits for the other. Offsets are kept in the checkpoint, so a restart goes on where
    the job stopped. A failure of either ends the job with that error.
    """
    if apart:
        queries = [
            start_store(messages, writer, f"{checkpoint}/store", options, every=every),
            start_route(messages, route_path, f"{checkpoint}/route", options, whole=whole, every=every),
        ]
    else:
        queries = [start_fan_out(messages, writer, route_path, f"{checkpoint}/store", options, whole=whole, every=every)]
    try:
        while any(query.isActive for query in queries):
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
        for query in queries:
            if query.exception():
                raise query.exception()
    finally:
        for query in queries:
            query.stop()


def start_judged(
    messages: DataFrame,
    judge: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    options: JobOptions = JobOptions(),
    *,
    every: str | None = None,
) -> StreamingQuery:
    """Write what ``judge`` makes of the accepted transactions of each batch: see :mod:`riskstream.streaming.profiles`."""
    accepted = log_rows(messages, options.threshold).where(F.col("outcome") == STORED)
    return (
        accepted.select(*STORED_COLUMNS, "position")
        .writeStream.foreachBatch(judged_writer(path, checkpoint, judge))
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def run_backfill(
    messages: DataFrame,
    writer: BatchWriter | str,
    checkpoint: str,
    options: JobOptions = JobOptions(),
) -> None:
    """Store everything there is now, from the earliest message, and stop.

    Meant for the insert-ignore rule: a full replay then changes nothing. It
    does not forward flagged messages.
    """
    start_store(messages, writer, checkpoint, options).awaitTermination()
