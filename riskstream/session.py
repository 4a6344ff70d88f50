"""Spark session and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from riskstream import files
from riskstream.options import JobOptions

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(options: JobOptions | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is written for.

    Shuffle partition counts and executor sizes belong to the cluster and are
    not set here; AQE coalesces partitions, splits skewed joins, and hashes the small
    side of a join instead of sorting both where each partition of it is small. The
    log writes two outcomes side by side instead of sorting each batch by outcome.
    """
    options = options or JobOptions()
    builder = (
        SparkSession.builder.appName(options.app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .config("spark.sql.maxConcurrentOutputFileWriters", "4")
        .config("spark.ui.enabled", "false")
    )
    if options.master:
        builder = builder.master(options.master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path every executor can reach.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``. Only a
    local session, whose executors share this machine, may do without one. The
    folder stays until :func:`release`.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="riskstream-")
    _made.append(f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}")
    return _made[-1]


_made: list[str] = []


def release(spark: SparkSession) -> None:
    """Remove the intermediate tables made so far. Results that are still to be read need them."""
    while _made:
        files.remove(spark, _made.pop())


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage in a way that survives the loss of executors, fixes the
    outcome of anything non-deterministic, and lets the planner see the true
    size, so that it broadcasts the table only when it fits.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
