"""Commit records: what each write job put into a sink, kept beside it.

Every write names its files after a job id of its own (``part-<job>-...``) and leaves one
small record under ``<sink>/_commits/<job>.json`` once Spark has committed the job: mode,
partition column, the partition values it wrote and how many rows, both observed in the
write job's own result tasks.  Reports and read-backs go by that record: they open only the folders
of the job's own partitions, and there only files that carry its id.  So their cost
follows one run and not the sink's history, and files that another writer adds meanwhile
never count.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cargoline import storage

RECORDS = "_commits"


@dataclasses.dataclass(frozen=True)
class Commit:
    """One committed write job; ``partitions`` are the values it wrote (None: null or blank)."""

    job: str
    path: str
    format: str
    mode: str
    partition_column: str | None
    partitions: tuple[str | None, ...]
    rows: int
    committed_at: str

    def folders(self, spark: SparkSession) -> list[str]:
        """The folders that hold this job's files; none if it wrote no row."""
        if not self.rows:
            return []
        if self.partition_column is None:
            return [self.path]
        return sorted({f"{self.path}/{storage.partition_folder(spark, self.partition_column, v)}" for v in self.partitions})

    @property
    def file_pattern(self) -> str:
        return f"{basename(self.job)}-*"


def basename(job: str) -> str:
    return f"part-{job}"


def new_job() -> str:
    return uuid.uuid4().hex


def observed(df: DataFrame, partition_column: str | None) -> tuple[DataFrame, Observation]:
    """``df`` with its rows and partition values observed where it stands: right above a write, so in
    the tasks that write, whose metrics Spark counts once however often they are tried."""
    seen = Observation("committed")
    exprs = [F.count(F.lit(1)).alias("rows")]
    if partition_column:
        value = F.col(partition_column).cast("string")
        exprs += [F.collect_set(value).alias("values"), F.count_if(value.isNull()).alias("nulls")]
    return df.observe(seen, *exprs), seen


def record(spark: SparkSession, path: str, fmt: str, mode: str, job: str, partition_column: str | None, seen: Observation | None) -> Commit:
    """Write the record of a committed job (``seen`` None: a job that was skipped, which leaves none)."""
    got = (seen.get if seen is not None else None) or {}
    values = sorted(got.get("values") or []) + ([None] if got.get("nulls") else [])
    commit = Commit(
        job, path, fmt, mode, partition_column, tuple(values), int(got.get("rows") or 0), dt.datetime.now(dt.timezone.utc).isoformat(timespec="milliseconds")
    )
    if seen is not None:
        storage.write_text(spark, f"{path}/{RECORDS}/{job}.json", json.dumps({k: v for k, v in dataclasses.asdict(commit).items() if k != "path"}))
    return commit


COMMIT_ROWS = (
    "job string, mode string, format string, partition_column string, partitions array<string>, rows bigint, committed_at timestamp"
)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """``COMMIT_ROWS`` of all write jobs whose files the sink may still hold (a static overwrite ends its predecessors)."""
    if not storage.exists(spark, f"{path}/{RECORDS}"):
        return spark.createDataFrame([], COMMIT_ROWS)
    return spark.read.schema(COMMIT_ROWS).json(f"{path}/{RECORDS}")
