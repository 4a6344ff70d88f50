"""Messages and rows that tests are made from."""

import json
from datetime import datetime

from riskstream.schema import STORED_SCHEMA

MESSAGE = {
    "transaction_id": "a",
    "timestamp": "2025-01-02T03:04:05",
    "customer_id": 1001,
    "customer_name": "Ann",
    "amount": 100.0,
    "currency": "USD",
    "merchant": "Shop",
    "location": "Town",
    "status": "SUCCESS",
    "card_type": "VISA",
}


def message(**changes):
    """A complete message with some fields changed; None leaves a field out."""
    return {k: v for k, v in {**MESSAGE, **changes}.items() if v is not None}


def lines(folder, name, messages):
    """Write messages as a file of JSON lines; text goes in as it is."""
    folder.mkdir(exist_ok=True)
    text = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    (folder / name).write_text("\n".join(text) + "\n")


def stored_rows(spark, rows):
    """Rows of the stored table from partial dicts."""
    base = {**MESSAGE, "timestamp": datetime(2025, 1, 2, 3, 4, 5), "is_suspicious": False}
    full = [{**base, **row} for row in rows]
    data = [tuple(r[f] for f in STORED_SCHEMA.names) for r in full]
    return spark.createDataFrame(data, STORED_SCHEMA)
