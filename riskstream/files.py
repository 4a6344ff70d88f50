"""Small files next to the tables, in whatever file system they are: read and written by the driver."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _at(spark, path)
    return system.exists(place)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text; FileNotFoundError if there is none."""
    place, system = _at(spark, path)
    if not system.exists(place):
        raise FileNotFoundError(path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")  # noqa: SLF001
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, whole or not at all. One that is there already stays as it is."""
    place, system = _at(spark, path)
    if system.exists(place):
        return
    system.mkdirs(place.getParent())
    draft, _ = _at(spark, f"{place.getParent()}/.{uuid.uuid4().hex}")
    stream = system.create(draft)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not system.rename(draft, place):
        system.delete(draft, False)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, hidden files left out; nothing if there is no folder."""
    place, system = _at(spark, path)
    if not system.exists(place):
        return []
    found = (entry.getPath().getName() for entry in system.listStatus(place))
    return sorted(name for name in found if not name.startswith("."))


def remove(spark: SparkSession, path: str) -> None:
    place, system = _at(spark, path)
    system.delete(place, True)
