"""Listings through Hadoop's file systems, so any URI Spark reads can be listed."""

from __future__ import annotations

import dataclasses
import re
from urllib.parse import unquote

from pyspark.sql import SparkSession

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
PLAIN = re.compile(r"[A-Za-z0-9_.-]+")


@dataclasses.dataclass(frozen=True, order=True)
class StoredFile:
    path: str
    length: int
    modified_ms: int


def _open(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def files(spark: SparkSession, path: str) -> list[StoredFile]:
    """All data files under ``path`` (nested folders too), sorted; none if it is missing."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return []
    out, it = [], fs.listFiles(p, True)
    while it.hasNext():
        f = it.next()
        if not f.getPath().getName().startswith(("_", ".")):
            out.append(StoredFile(f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if it is missing."""
    fs, p = _open(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(p)] if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    fs, p = _open(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, written by the driver."""
    fs, p = _open(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def partition_folder(spark: SparkSession, column: str, value: str | None) -> str:
    """The folder name ``column=value`` as Spark's partitioned writes escape it; null and '' share one."""
    if value and PLAIN.fullmatch(column + value):
        return f"{column}={value}"  # nothing to escape
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(column, value)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str | None]:
    """Values of the ``column=value`` folders directly under ``path``: one call, no folder is opened."""
    out = []
    for name in children(spark, path):
        if name.startswith(f"{column}="):
            value = unquote(name.partition("=")[2])
            out.append(None if value == NULL_FOLDER else value)
    return out
