"""Forwarding of flagged transactions to a second stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from riskstream.operators.decode import decode, encode, encode_whole, with_flag
from riskstream.operators.filters import only_suspicious
from riskstream.options import JobOptions
from riskstream.schema import DEFAULT_THRESHOLD
from riskstream.streaming.log import BatchWriter, job_id


def flagged_messages(
    messages: DataFrame, threshold: float = DEFAULT_THRESHOLD, *, whole: bool = False
) -> DataFrame:
    """Key and JSON of every flagged message, whether or not the table takes it.

    ``whole`` forwards the message as it came, unknown fields included, without a key.
    """
    return routed(with_flag(decode(messages), threshold), whole=whole)


def routed(flagged: DataFrame, *, whole: bool = False) -> DataFrame:
    """The same of messages that are decoded and flagged already."""
    rows = only_suspicious(flagged)
    return encode_whole(rows) if whole else encode(rows)


def file_route_writer(path: str, checkpoint: str) -> BatchWriter:
    """Writes one batch of routed messages to a folder of its job that a replay overwrites."""

    def write(batch: DataFrame, batch_id: int) -> None:
        job = job_id(batch.sparkSession, checkpoint)
        batch.write.mode("overwrite").parquet(f"{path}/job={job}/batch_id={batch_id}")

    return write


def kafka_route_writer(options: JobOptions) -> BatchWriter:
    """Sends one batch of routed messages to the flagged topic, at least once. Needs the Kafka connector."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format("kafka").options(**_topic(options)).save()

    return write


def to_kafka(routed: DataFrame, options: JobOptions) -> DataStreamWriter:
    """The stream writer for the flagged topic. Needs the Kafka connector."""
    return routed.writeStream.format("kafka").options(**_topic(options))


def _topic(options: JobOptions) -> dict[str, str]:
    return {"kafka.bootstrap.servers": options.broker, "topic": options.flagged_topic}
