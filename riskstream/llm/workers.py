"""What the Python workers of the executors hold in memory."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of an Arrow batch sent to a worker. Texts are long, and a batch is in memory several times over.
BATCH_BYTES = 4 << 20

_held: list = []


def held[T, S](source: S, build: Callable[[S], T]) -> T:
    """``build(source)``, built once in a worker for a broadcast value; only the latest is kept."""
    if not _held or _held[0] is not source:
        _held.clear()
        pa.default_memory_pool().release_unused()
        _held[:] = [source, build(source)]
    return _held[1]


def small_batches(spark: SparkSession) -> SparkSession:
    """Have the session send Arrow batches of BATCH_BYTES at most, if it would send larger ones."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name, "64m").lower()
    units = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    size = int(now.rstrip("bkmg") or -1) * units.get((now.rstrip("b") or "b")[-1], 1)
    if size <= 0 or size > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))
    return spark
