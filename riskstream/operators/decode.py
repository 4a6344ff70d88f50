"""JSON messages to typed columns and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from riskstream.functions import over_threshold
from riskstream.schema import DEFAULT_THRESHOLD, FLAG, KEY, STORED_COLUMNS, WIRE_SCHEMA


def decode(df: DataFrame, schema: StructType = WIRE_SCHEMA, value: str = "value") -> DataFrame:
    """Parse the message column into the fields of ``schema``.

    Fields the schema does not name are dropped; a field of the wrong type, or
    every field of a text that is no JSON object, becomes null. The message text
    stays as ``raw`` and all other columns pass through.

    The fields come out of a generator, one row each: the planner would copy a
    plain ``from_json`` into every later filter and parse the text again there.
    """
    others = [c for c in df.columns if c != value]
    text = df.select(*others, F.col(value).cast("string").alias("raw"))
    return text.select(*others, "raw", F.inline(F.array(F.from_json("raw", schema))))


def with_flag(df: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Add the flag: amount strictly above the threshold."""
    return df.withColumn(FLAG, over_threshold(threshold))


def encode(df: DataFrame) -> DataFrame:
    """Key and JSON value of each row, as forwarded to the second topic.

    Null fields are left out of the JSON.
    """
    present = [c for c in STORED_COLUMNS if c in df.columns]
    return df.select(
        F.col(KEY).cast("string").alias("key"), F.to_json(F.struct(*present)).alias("value")
    )


def encode_whole(df: DataFrame) -> DataFrame:
    """The incoming message with the flag added at its end, no key.

    The text is not taken apart: unknown fields, nulls, repeated names and NaN go on as they
    came. A reader takes the last of repeated names, as :func:`decode` does, so the flag
    holds even if the message had one of its own.
    """
    flag = F.concat(F.lit(f', "{FLAG}": '), F.col(FLAG).cast("string"), F.lit("}"))
    opened = F.regexp_replace("raw", r"(?s)\s*\}[^}]*\z", "")
    return df.select(F.lit(None).cast("string").alias("key"), F.concat(opened, flag).alias("value"))
