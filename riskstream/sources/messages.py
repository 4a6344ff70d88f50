"""Message sources: one row per message, with ``value`` and ``position``.

The same columns whether the messages come from Kafka or from files, whether
read as a stream or as a batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskstream.options import JobOptions
from riskstream.schema import POSITION_TYPE


def position(delivered_at: Column, source: Column, part: Column, offset: Column) -> Column:
    """A message's place in delivery order."""
    fields = zip(POSITION_TYPE, (delivered_at, source, part, offset), strict=True)
    return F.struct(*(value.cast(f.dataType).alias(f.name) for f, value in fields)).alias("position")


def kafka_settings(options: JobOptions, starting_offsets: str, *, streaming: bool) -> dict[str, str]:
    settings = {
        "kafka.bootstrap.servers": options.broker,
        "subscribe": options.topic,
        "startingOffsets": starting_offsets,
    }
    if streaming and options.max_offsets_per_trigger:
        settings["maxOffsetsPerTrigger"] = str(options.max_offsets_per_trigger)
    if options.min_partitions:
        settings["minPartitions"] = str(options.min_partitions)
    return settings


def kafka_messages(
    spark: SparkSession,
    options: JobOptions,
    *,
    starting_offsets: str = "latest",
    streaming: bool = True,
    by_time: bool = True,
) -> DataFrame:
    """Messages of a topic. Needs the Kafka connector of the running Spark version.

    ``starting_offsets`` applies to a new checkpoint only; later runs go on where
    the last one stopped. Delivery order goes by the time of the message, then by
    partition and offset. Without ``by_time`` it goes by partition and offset alone:
    right where all messages of a transaction share a partition. ``min_partitions``
    of the options has large topic partitions read by several tasks.
    """
    reader = spark.readStream if streaming else spark.read
    settings = kafka_settings(options, starting_offsets, streaming=streaming)
    time = F.col("timestamp") if by_time else F.lit(None)
    return reader.format("kafka").options(**settings).load().select(
        "value", position(time, F.col("topic"), F.col("partition"), F.col("offset"))
    )


def file_messages(
    spark: SparkSession, folder: str, *, streaming: bool = True, max_files_per_trigger: int = 1000
) -> DataFrame:
    """Messages from a folder of text files, one JSON object per line."""
    if streaming:
        reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        reader = spark.read
    messages = reader.text(folder).select(
        "value",
        position(
            F.col("_metadata.file_modification_time"),
            F.col("_metadata.file_path"),
            F.col("_metadata.file_block_start"),
            F.lit(None),
        ),
    )
    return messages if streaming else with_offsets(messages)


def with_offsets(batch: DataFrame) -> DataFrame:
    """Fill in missing offsets with the number of the row in its task.

    A block of a file is read by one task from start to end, so this is the order
    of its lines. Streams may not number rows; the writers do so for each batch.
    """
    offset = F.coalesce(F.col("position.offset"), F.monotonically_increasing_id())
    return batch.withColumn("position", F.col("position").withField("offset", offset))
