"""The delivery job (X4): source -> transformation -> sink, one scan of the input.

The original job counted rows after every step (16 Spark actions, each
re-reading the input).  Here a run with reports reads its input once: the rows are de-duplicated
with their multiplicities into a written intermediate, from which come the profile of the input,
the rows left after each step and the rows to write.  A run without reports is one lazy
plan from the scan to the sink.  What a run wrote is told by its commit record
(``cargoline.sinks.commits``), so appends, retried tasks and skipped writes report what is there and no
listing of the sink is needed.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import functools
import logging
import time
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargoline.operators.filters import to_day
from cargoline.operators.profile import ALL_TYPES, funnel_of, info_of, output_summary, profile_of, with_multiplicity
from cargoline.plans.transform import DeliveryRules, QualityChecks, standardize, transform
from cargoline.schema import COUNTRY_CODES, OUTPUT_SCHEMA, RAW_COLUMNS
from cargoline.session import bytes_of, scratch_path, settings
from cargoline.sinks.commits import Commit
from cargoline.sinks.files import SinkSpec, commit_write, read_back, stored_rows
from cargoline.sources.csv import read_deliveries

log = logging.getLogger(__name__)

SPLIT = "spark.sql.files.maxPartitionBytes"
# What one task of the intake reads at most: nearly all its rows differ, and its hash map holds them (about 15 bytes for one).
SPLIT_BYTES = 16 << 20


@dataclasses.dataclass(frozen=True)
class RunParams:
    """Run arguments; all are checked before any Spark job starts."""

    start_date: str
    end_date: str
    output: SinkSpec
    country: str | None = None
    rules: DeliveryRules = DeliveryRules()
    quality: QualityChecks = QualityChecks()
    profile_input: bool = True
    multiline: bool = True  # the input CSV's fields may hold line breaks; else files can be split

    @classmethod
    def from_mapping(cls, cfg: Mapping[str, Any]) -> RunParams:
        """Run arguments from the original job's settings tree (e.g. its YAML
        file loaded with ``yaml.safe_load``): ``filters``, ``transformations``,
        ``data_quality``, ``output`` and ``paths.output_base``.  Missing keys
        take the original defaults; ``spark`` settings belong to the session.
        """

        def get(path: str, default: Any = None) -> Any:
            node: Any = cfg
            for part in path.split("."):
                if not isinstance(node, Mapping) or part not in node:
                    return default
                node = node[part]
            return default if node is None else node

        return cls(
            start_date=get("filters.start_date"),
            end_date=get("filters.end_date"),
            country=get("filters.country"),
            output=SinkSpec(
                get("paths.output_base"),
                format=get("output.format", "parquet"),
                partition_column=get("output.partition_column", "process_date"),
                mode=get("output.mode", "overwrite"),
                compression=get("output.compression", "snappy"),
            ),
            rules=DeliveryRules(
                cs_to_st_factor=int(get("transformations.unit_conversion.cs_to_st_factor", 20)),
                routine_delivery_types=get("transformations.delivery_types.routine"),
                bonus_delivery_types=get("transformations.delivery_types.bonus"),
            ),
            quality=QualityChecks.of(get("data_quality", {})),
            profile_input=bool(get("reader.profile", True)),
            multiline=bool(get("reader.multiline", True)),
        )

    def check(self) -> None:
        start = _checked_day(self.start_date, "start_date")
        end = _checked_day(self.end_date, "end_date")
        if start > end:
            raise ValueError(f"start_date {self.start_date} is after end_date {self.end_date}")
        if self.country and self.country.upper() not in COUNTRY_CODES:
            raise ValueError(
                f"invalid country code: {self.country}; valid: {', '.join(COUNTRY_CODES)}"
            )


def _checked_day(value: str, name: str) -> dt.date:
    try:
        return to_day(value)
    except (TypeError, ValueError) as exc:
        raise ValueError(f"invalid date for {name}: {value!r}; use YYYY-MM-DD") from exc


@dataclasses.dataclass
class RunResult:
    """What one run read and wrote; a skipped write committed no rows."""

    output_path: str
    seconds: float
    spark: SparkSession
    output: SinkSpec
    commit: Commit
    params: RunParams
    source: DataFrame
    intake: DataFrame | None = None  # the written intermediate of a run with reports

    def written(self) -> DataFrame:
        """This run's rows, read back with the standard schema (so partition
        values such as ``process_date`` stay text, nothing is inferred)."""
        return read_back(self.spark, self.output, OUTPUT_SCHEMA, self.commit)

    @property
    def rows_written(self) -> int:
        """Rows that this run's write job committed."""
        return self.commit.rows

    def rows_per_partition(self) -> DataFrame:
        """Rows by partition value, from the footers of this run's files."""
        column = self.commit.partition_column or "process_date"
        return stored_rows(self.spark, self.output, column, OUTPUT_SCHEMA, self.commit)

    def summary(self) -> DataFrame:
        """``total_records`` and ``partition_values`` of this run alone.

        From the commit record; an unpartitioned write's values are counted in its files.
        """
        if self.commit.rows and not self.commit.partition_column:
            return output_summary(self.written(), "process_date")
        values = len(set(self.commit.partitions)) if self.commit.rows else 0
        return self.spark.range(1).select(F.lit(self.commit.rows).cast("bigint").alias("total_records"), F.lit(values).cast("bigint").alias("partition_values"))

    def metrics(self) -> DataFrame:
        """One row of run metrics: target, format, rows written and partition values of this run, seconds."""
        return self.summary().select(
            F.lit(self.output_path).alias("output_path"), F.lit(self.output.format).alias("output_format"),
            F.col("total_records").alias("rows_written"), "partition_values", F.lit(float(self.seconds)).alias("seconds"),
        )

    def _reported(self) -> DataFrame:
        if self.intake is None:
            raise ValueError("this run kept no reports; set RunParams.profile_input")
        return self.intake

    def input_profile(self) -> DataFrame:
        """``(column_name, value, rows)`` of the run's input (P1)."""
        return profile_of(self._reported())

    @functools.cached_property
    def input_info(self) -> dict | None:
        """Row count, columns, schema and numbers of distinct values of the input."""
        return None if self.intake is None else info_of(self.source, self.input_profile())

    def funnel(self) -> DataFrame:
        """``(step, stage, rows)``: the rows left after each step of this run (P3)."""
        p = self.params
        types = p.rules.valid_delivery_types if p.quality.filter_valid_delivery_types else ALL_TYPES
        return funnel_of(self._reported(), p.start_date, p.end_date, p.country, types)


def take_in(source: DataFrame, quality: QualityChecks) -> DataFrame:
    """The one scan of a run with reports: ``with_multiplicity`` written under the shared scratch root.

    The run's own filters and its reports read it; a lost executor costs no second look at the input.
    Its tasks read at most ``SPLIT_BYTES`` each of files that can be split, whatever the session's setting.
    """
    spark = source.sparkSession
    grouped = with_multiplicity(source, quality.remove_empty_material, quality.remove_duplicates, quality.fix_scientific_notation)
    path = scratch_path(spark, "run-intake")
    with settings(spark, {SPLIT: min(bytes_of(spark, SPLIT), SPLIT_BYTES)}):
        grouped.write.parquet(path)
    return spark.read.schema(grouped.schema).parquet(path)


def run_delivery_job(source: DataFrame, params: RunParams) -> RunResult:
    """Transform ``source`` (nine raw columns) and write it as ``params.output``."""
    params.check()
    t0 = time.time()
    arguments = dict(country=params.country, quality=params.quality, rules=params.rules)
    if params.profile_input:
        intake = take_in(source, params.quality)
        cleaned = intake.where(~F.col("dropped")).select(*RAW_COLUMNS)
        out = standardize(cleaned, params.start_date, params.end_date, **arguments)
    else:
        intake, out = None, transform(source, params.start_date, params.end_date, **arguments)
    commit = commit_write(out, params.output)
    secs = time.time() - t0
    log.info("job %s wrote %d rows to %s in %.2fs", commit.job, commit.rows, params.output.path, secs)
    return RunResult(params.output.path, secs, source.sparkSession, params.output, commit, params, source, intake)


def run_delivery_job_from_csv(spark: SparkSession, input_path: str, params: RunParams) -> RunResult:
    """The original entry point: deliveries CSV in, standard output files out."""
    params.check()
    return run_delivery_job(read_deliveries(spark, input_path, multiline=params.multiline), params)


def run_from_mapping(spark: SparkSession, cfg: Mapping[str, Any]) -> RunResult:
    """Run with the original job's settings tree (``paths.input_file`` is the CSV)."""
    params = RunParams.from_mapping(cfg)
    return run_delivery_job_from_csv(spark, cfg["paths"]["input_file"], params)
