"""Job options, read from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from riskstream.schema import DEFAULT_THRESHOLD


@dataclass(frozen=True)
class JobOptions:
    """Everything a job needs to know. There are no default credentials."""

    app_name: str = "riskstream"
    master: str | None = None
    broker: str = "localhost:9092"
    topic: str = "transactions"
    flagged_topic: str = "suspicious-transactions"
    threshold: float = DEFAULT_THRESHOLD
    db_host: str = "localhost"
    db_port: int = 5432
    db_name: str | None = None
    db_user: str | None = None
    db_password: str | None = None
    db_table: str = "transactions"
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> JobOptions:
        env = os.environ if env is None else env
        # The variable names a deployment already sets.
        names = {
            "app_name": "SPARK_APP_NAME",
            "master": "SPARK_MASTER",
            "broker": "KAFKA_BROKER",
            "topic": "KAFKA_TOPIC",
            "flagged_topic": "SUS_TOPIC",
            "threshold": "FRAUD_THRESHOLD",
            "db_host": "DB_HOST",
            "db_port": "DB_PORT",
            "db_name": "DB_NAME",
            "db_user": "DB_USER",
            "db_password": "DB_PASS",
            "max_offsets_per_trigger": "MAX_OFFSETS_PER_TRIGGER",
            "min_partitions": "MIN_PARTITIONS",
        }
        types = {"threshold": float} | dict.fromkeys(
            ("db_port", "max_offsets_per_trigger", "min_partitions"), int
        )
        given = {
            field: types.get(field, str)(env[name])
            for field, name in names.items()
            if env.get(name)
        }
        return cls(**given)

    @property
    def jdbc_url(self) -> str:
        if not self.db_name:
            raise ValueError("no database name given (DB_NAME)")
        return f"jdbc:postgresql://{self.db_host}:{self.db_port}/{self.db_name}"
