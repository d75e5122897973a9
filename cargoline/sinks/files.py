"""File sinks: Parquet / CSV / JSON (K1-K3), hive partitioning (K4), save
modes (K5), per-date overwrite (K6) and the format check (K7).

Before a partitioned write the rows are rebalanced on the partition column
(an AQE ``REBALANCE`` hint): each partition value is written by few tasks,
so the number of files stays near the number of values instead of
tasks x values, and AQE splits a value that holds a large share of the rows
over several tasks instead of sending it to one.
"""

from __future__ import annotations

import dataclasses
import logging

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cargoline.sinks.commits import RECORDS, Commit, basename, new_job, observed, record
from cargoline.storage import children, delete, exists, partition_values

log = logging.getLogger(__name__)

BASENAME = "mapreduce.output.basename"  # Hadoop's name for the beginning of output file names
EXISTS = "cargoline: date already in the sink"
FORMATS = ("parquet", "csv", "json")
MODES = ("overwrite", "append", "error", "errorifexists", "ignore")


class SinkExistsError(RuntimeError):
    """Raised by ``write_by_date`` in ``error`` mode when a date already exists."""


@dataclasses.dataclass(frozen=True)
class SinkSpec:
    """Where and how the output is written."""

    path: str
    format: str = "parquet"
    partition_column: str | None = "process_date"
    mode: str = "overwrite"
    compression: str = "snappy"

    def __post_init__(self) -> None:
        fmt = self.format.lower()
        if fmt not in FORMATS:
            raise ValueError(f"unsupported output format: {self.format!r}")
        if self.mode.lower() not in MODES:
            raise ValueError(f"unsupported save mode: {self.mode!r}")
        object.__setattr__(self, "format", fmt)
        object.__setattr__(self, "mode", self.mode.lower())


def _save(df: DataFrame, spec: SinkSpec, how: str, partition_col: str | None, called: str | None = None) -> Commit:
    """Write ``df`` as one job with file names of its own, and record what it committed.

    ``how``: Spark's mode, or ``dynamic`` to replace the partitions that ``df`` fills; ``called``: the mode recorded.
    """
    job = new_job()
    if partition_col:
        df = df.hint("rebalance", partition_col)
    df, seen = observed(df, partition_col)
    w = df.write.mode("overwrite" if how == "dynamic" else how).format(spec.format).option(BASENAME, basename(job))
    if spec.format == "parquet":
        w = w.option("compression", spec.compression)
    elif spec.format == "csv":
        w = w.option("header", True).option("quote", '"').option("escape", '"')
    if how == "dynamic":
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.save(spec.path)
    return record(df.sparkSession, spec.path, spec.format, called or how, job, partition_col, seen)


def _drop_superseded(spark: SparkSession, commit: Commit) -> None:
    """After an overwrite has committed: what it replaces goes, first from the record, then from the sink.

    Folders of the job's own partitions hold only its files by then; others are deleted whole.
    """
    for name in children(spark, f"{commit.path}/{RECORDS}"):
        if name != f"{commit.job}.json":
            delete(spark, f"{commit.path}/{RECORDS}/{name}")
    own = {f.rsplit("/", 1)[1] for f in commit.folders(spark)} if commit.partition_column else set()
    for name in children(spark, commit.path):
        if not name.startswith(("_", ".")) and name not in own and not name.startswith(f"{basename(commit.job)}-"):
            delete(spark, f"{commit.path}/{name}")


def commit_write(df: DataFrame, spec: SinkSpec, partition_by: str | None = None) -> Commit:
    """Write ``df`` as ``spec`` says and return the job's commit record.

    ``partition_by`` overrides the spec's column for this call.  When the
    chosen column is not in ``df`` the data is written unpartitioned.

    ``overwrite`` replaces the whole sink, but only once the new files are committed: a run that fails
    midway leaves the old rows as they are.  ``ignore`` writes nothing if the path is
    there; ``error`` then fails before any job.
    """
    spark = df.sparkSession
    col = partition_by or spec.partition_column
    if col and col not in df.columns:
        log.warning("partition column %r not in frame; writing unpartitioned", col)
        col = None
    if spec.mode == "ignore" and exists(spark, spec.path):
        return record(spark, spec.path, spec.format, spec.mode, new_job(), col, None)
    if spec.mode != "overwrite":
        return _save(df, spec, spec.mode, col)
    fresh = not exists(spark, spec.path)
    # Parts of the sink that the new rows fill are swapped when the job commits, by Spark; the rest goes after it.
    commit = _save(df, spec, "dynamic" if col else "append", col, "overwrite")
    if not fresh:
        _drop_superseded(spark, commit)
    return commit


def write(df: DataFrame, spec: SinkSpec, partition_by: str | None = None) -> str:
    """Write ``df`` as ``spec`` says (see ``commit_write``); returns the output path."""
    return commit_write(df, spec, partition_by).path


def read_back(
    spark: SparkSession,
    spec: SinkSpec,
    schema: StructType | str | None = None,
    commit: Commit | None = None,
    multiline: bool = True,
) -> DataFrame:
    """Read a sink's output, or only what one write job committed (partition columns come back last).

    A commit's files are found in the folders of its own partitions, by their names.  CSV fields may
    hold line breaks, so CSV files are read whole; ``multiline=False`` lets Spark split
    files that hold none.
    """
    folders = commit.folders(spark) if commit is not None else [spec.path]
    if not folders:
        if schema is None:
            raise ValueError("no files and no schema")
        return spark.createDataFrame([], schema)
    r = spark.read.format(spec.format)
    if spec.format == "csv":
        r = r.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multiline)
    if schema is not None:
        r = r.schema(schema)
    if commit is not None:
        r = r.option("basePath", spec.path).option("pathGlobFilter", commit.file_pattern)
    return r.load(folders)


def stored_rows(
    spark: SparkSession,
    spec: SinkSpec,
    column: str = "process_date",
    schema: StructType | str | None = None,
    commit: Commit | None = None,
    multiline: bool = True,
) -> DataFrame:
    """``(column, rows)`` of a sink, or of one commit's files.

    No data column is read: of Parquet files only the footers, which hold the row
    counts; CSV and JSON lines have to be scanned.
    """
    return read_back(spark, spec, schema, commit, multiline).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def write_by_date(
    df: DataFrame,
    spec: SinkSpec,
    date_column: str = "process_date",
    schema: StructType | None = None,
    multiline: bool = True,
) -> DataFrame:
    """Write ``df`` into ``spec.path/<date_column>=<value>`` directories in one job.

    overwrite -> only the dates present in ``df`` are replaced (dynamic
    partition overwrite); append -> added; ignore -> dates already present
    are skipped; error -> ``SinkExistsError`` if any date is present, found
    while the one write job runs, which then commits nothing.  Dates already
    there are taken from the sink's folder names; no old file is opened.

    Returns ``(date_column, path, rows)`` of this call's dates, counted from the
    files this call committed.  They are read with ``schema``, by default the
    frame's own, so date values keep their type.
    """
    if date_column not in df.columns:
        raise ValueError(f"date column {date_column!r} not in frame")
    schema = schema if schema is not None else df.schema
    spark = df.sparkSession
    mode, out = spec.mode, df
    if mode in ("ignore", "error", "errorifexists"):
        present = partition_values(spark, spec.path, date_column)
        if present:
            kind = df.schema[date_column].dataType
            known = spark.createDataFrame([(v,) for v in present], "_present string").select(
                F.col("_present").cast(kind), F.lit(True).alias("_there")
            )
            hit = df[date_column].eqNullSafe(known["_present"])
            if mode == "ignore":
                out = df.join(known, hit, "left_anti")
            else:
                stop = F.when(F.col("_there"), F.raise_error(F.lit(EXISTS).cast("string")).cast(kind)).otherwise(df[date_column])
                out = df.join(known, hit, "left").select(*[(stop if c == date_column else df[c]).alias(c) for c in df.columns])
        mode = "append"
    try:
        commit = _save(out, spec, "dynamic" if mode == "overwrite" else mode, date_column, "overwrite dates" if mode == "overwrite" else mode)
    except PySparkException as exc:
        if EXISTS in str(exc):
            raise SinkExistsError(f"dates already written under {spec.path}") from exc
        raise
    return rows_per_directory(spark, spec, date_column, schema, commit, multiline)


def rows_per_directory(
    spark: SparkSession,
    spec: SinkSpec,
    column: str,
    schema: StructType | None = None,
    commit: Commit | None = None,
    multiline: bool = True,
) -> DataFrame:
    """``(column, path, rows)`` for the directories of one commit, or of the whole sink."""
    if commit is not None and not commit.rows:
        kind = (schema[column].dataType if schema is not None else "string")
        return spark.createDataFrame([], StructType([StructField(column, kind), StructField("path", StringType()), StructField("rows", LongType())]))
    data = read_back(spark, spec, schema, commit, multiline)
    directory = F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/[^/]*$", 1)
    return data.groupBy(F.col(column), directory.alias("path")).agg(
        F.count(F.lit(1)).alias("rows")
    )
