"""Shapes of the data: wire message, stored row, delivery log."""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# --- fixed values: message and table contract -------------------------------
WIRE_SCHEMA = StructType([
    StructField("transaction_id", StringType()),
    StructField("timestamp", StringType()),
    StructField("customer_id", IntegerType()),
    StructField("customer_name", StringType()),
    StructField("amount", DoubleType()),
    StructField("currency", StringType()),
    StructField("merchant", StringType()),
    StructField("location", StringType()),
    StructField("status", StringType()),
    StructField("card_type", StringType()),
])

REQUIRED = (
    "transaction_id", "timestamp", "customer_id", "customer_name", "amount",
    "currency", "merchant", "location", "status",
)

MAX_LENGTH = {
    "transaction_id": 50,
    "customer_name": 100,
    "currency": 10,
    "merchant": 100,
    "location": 100,
    "status": 20,
    "card_type": 20,
}

DEFAULT_THRESHOLD = 3000.0
# -----------------------------------------------------------------------------

# Timestamps of other years are taken for errors. This also bounds every series over time.
FIRST_YEAR, LAST_YEAR = 1900, 2199

KEY = "transaction_id"
FLAG = "is_suspicious"
FACETS = ("status", "location", "card_type")
WIRE_COLUMNS = tuple(WIRE_SCHEMA.names)
STORED_COLUMNS = (*WIRE_COLUMNS, FLAG)

# Where a message stood in its source. Ordering this struct gives delivery order:
# Kafka fills it from (timestamp, topic, partition, offset), files from
# (modification time, path, block start, row).
POSITION_TYPE = StructType([
    StructField("delivered_at", TimestampType()),
    StructField("source", StringType()),
    StructField("part", LongType()),
    StructField("offset", LongType()),
])

STORED_SCHEMA = StructType(
    [
        StructField(f.name, TimestampNTZType() if f.name == "timestamp" else f.dataType)
        for f in WIRE_SCHEMA
    ]
    + [StructField(FLAG, BooleanType())]
)

# `job`, `batch_id` and `outcome` are directory levels of the log, not file columns.
# `written_at` is the time that the job's checkpoint has for the batch, which a replay finds there
# again: the order in which several jobs fill one table.
LOG_SCHEMA = StructType(
    STORED_SCHEMA.fields
    + [
        StructField("position", POSITION_TYPE),
        StructField("reason", StringType()),
        StructField("raw", StringType()),
        StructField("written_at", TimestampType()),
        StructField("job", StringType()),
        StructField("batch_id", LongType()),
        StructField("outcome", StringType()),
    ]
)

# A row's place in the order of arrival.
ARRIVAL_TYPE = StructType([
    StructField("written_at", TimestampType()),
    StructField("job", StringType()),
    StructField("batch_id", LongType()),
    StructField("position", POSITION_TYPE),
])

# A merged table also keeps which rows its values and its flags are from.
MERGED_SCHEMA = StructType([
    *STORED_SCHEMA,
    StructField("arrived", ARRIVAL_TYPE),
    StructField("flagged_at", ARRIVAL_TYPE),
])
