"""Writing batches to a database table that has the conflict rules built in."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame

from riskstream.options import JobOptions
from riskstream.schema import FLAG, KEY, MAX_LENGTH, REQUIRED, STORED_COLUMNS
from riskstream.sources.messages import with_offsets
from riskstream.sources.tables import jdbc_settings
from riskstream.streaming.log import BatchWriter, job_id, resolved

CONFLICT = {
    "insert_ignore": "DO NOTHING",
    "flag_upsert": f"DO UPDATE SET {FLAG} = EXCLUDED.{FLAG}",
}


def table_statement(table: str) -> str:
    """The definition of the table, with the constraints the validation mirrors."""
    types = {"timestamp": "TIMESTAMP", "customer_id": "INT", "amount": "FLOAT", FLAG: "BOOLEAN"}
    columns = [
        f"{c} {types.get(c) or f'VARCHAR({MAX_LENGTH[c]})'}"
        + (" UNIQUE" if c == KEY else "")
        + (" NOT NULL" if c in REQUIRED else "")
        + (" DEFAULT FALSE" if c == FLAG else "")
        for c in STORED_COLUMNS
    ]
    return f"CREATE TABLE IF NOT EXISTS {table} (id SERIAL PRIMARY KEY, {', '.join(columns)})"


def batches_statement(table: str) -> str:
    """The definition of the table that says which batches are merged."""
    return f"CREATE TABLE IF NOT EXISTS {table}_batches (job VARCHAR(36), batch_id BIGINT, PRIMARY KEY (job, batch_id))"


def staging_name(table: str, job: str, batch_id: int) -> str:
    """The staging table of one batch of one job: jobs side by side, and a batch that runs again, don't meet in it."""
    return f"{table}_{job.replace('-', '')}_{batch_id}"


def merge_statements(table: str, staging: str, rule: str, job: str, batch_id: int) -> list[str]:
    """Merge a staged batch, which holds an id once, into the table, unless that has been done; to run as one transaction.

    So a batch that runs again, after others of other jobs, changes nothing.
    """
    columns = ", ".join(STORED_COLUMNS)
    done = f"SELECT 1 FROM {table}_batches WHERE job = '{job}' AND batch_id = {batch_id}"
    return [
        f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging} "
        f"WHERE NOT EXISTS ({done}) ON CONFLICT ({KEY}) {CONFLICT[rule]}",
        f"INSERT INTO {table}_batches VALUES ('{job}', {batch_id}) ON CONFLICT DO NOTHING",
        f"DROP TABLE {staging}",
    ]


def database_writer(
    connect: Callable[[], Any],
    stage: Callable[[DataFrame, str], None],
    table: str,
    rule: str,
    checkpoint: str,
    *,
    connections: int = 16,
) -> BatchWriter:
    """Upserts a batch of log rows: written to a staging table by the executors, then merged in one transaction.

    ``connect`` opens a DB-API connection for the driver; ``stage`` writes rows to a table of
    the given name, in place of what it held. A batch is first reduced to one row per id. At
    most ``connections`` tasks write, which get the reduced rows by a shuffle, so the
    reduction itself keeps its tasks. Each batch of each job has a staging table of its own, which goes with the
    merge, and is merged once, even if it runs again. The tables are made with the first batch if they aren't there; a batch
    without rows is left out.
    """
    ready = []

    def execute(*statements: str) -> None:
        connection = connect()
        try:
            cursor = connection.cursor()
            for statement in statements:
                cursor.execute(statement)
            connection.commit()
        finally:
            connection.close()

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        if not ready:
            execute(table_statement(table), batches_statement(table))
            ready.append(True)
        job = job_id(batch.sparkSession, checkpoint)
        staging = staging_name(table, job, batch_id)
        rows = resolved(with_offsets(batch), rule, ("position",)).select(*STORED_COLUMNS)
        stage(rows.repartition(connections), staging)
        execute(*merge_statements(table, staging, rule, job, batch_id))

    return write


def jdbc_stage(options: JobOptions) -> Callable[[DataFrame, str], None]:
    """A ``stage`` for the database of the options; needs the JDBC driver."""

    def stage(rows: DataFrame, staging: str) -> None:
        settings = jdbc_settings(options)
        rows.write.format("jdbc").mode("overwrite").options(**settings).option("dbtable", staging).save()

    return stage


def postgres(**parameters: Any) -> Callable[[], Any]:
    """A ``connect`` for PostgreSQL; needs psycopg2 on the driver."""

    def connect() -> Any:
        import psycopg2

        return psycopg2.connect(**parameters)

    return connect
