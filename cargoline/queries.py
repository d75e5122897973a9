"""Registered queries: one per operator of the delivery job.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame computed
from the test tables (through the derived deliveries table).  Sink and
source queries write to a fresh folder under the cluster-shared root
(``spark.checkpoint.dir``) and return the rows read back from it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargoline.operators.audit import audit_bad_countries, audit_bad_dates, audit_countries_table
from cargoline.operators.clean import clean, drop_blank_material, drop_duplicates, fix_tiny_price
from cargoline.operators.enrich import (
    add_calculated_columns,
    classify_deliveries,
    convert_units,
    rename_to_standard,
    select_final,
)
from cargoline.operators.filters import (
    filter_country,
    filter_date_range,
    filter_delivery_types,
)
from cargoline.operators.profile import (
    cleaning_funnel,
    output_summary,
    profile_rows,
    profile_values,
    rows_per_partition,
)
from cargoline.functions import parse_process_date, quality_flag, total_value, unit_price
from cargoline.plans.run import RunParams, run_delivery_job, run_delivery_job_from_csv
from cargoline.plans.transform import DeliveryRules, from_standard, transform
from cargoline.schema import DELIVERY_SCHEMA, OUTPUT_SCHEMA, RAW_COLUMNS
from cargoline.session import scratch_path
from cargoline.sinks.commits import commits
from cargoline.sinks.files import SinkExistsError, SinkSpec, read_back, stored_rows, write, write_by_date
from cargoline.sources.csv import read_csv, read_csv_with_rejects, read_deliveries
from cargoline.sources.fixture import deliveries, land_deliveries, table

# Run parameters of the registered queries (the test tables span 1995-2001).
START, END = "1997-01-01", "1998-06-30"
LATER_START, LATER_END = "1998-01-01", "1998-12-31"
FIRST_HALF = ("1997-01-01", "1997-12-31")
SECOND_HALF = ("1997-07-01", "1998-06-30")
COUNTRY = "GT"
CUSTOM_ROUTINE = ("ZPRE",)
CUSTOM_BONUS = ("Z04", "COBR")
CODES_WITHOUT_JM = ("GT", "PE", "EC", "SV", "HN")

Query = Callable[[SparkSession, str], DataFrame]


def _output(spark: SparkSession, sf_dir: str, start: str = START, end: str = END) -> DataFrame:
    """The standard output (with its run timestamp) for one date range."""
    return transform(deliveries(spark, sf_dir), start, end)


def _values(df: DataFrame) -> DataFrame:
    """Standard output minus the run timestamp (compared by value)."""
    return df.drop("processing_timestamp")


def _spec(spark: SparkSession, name: str, **kw) -> SinkSpec:
    return SinkSpec(scratch_path(spark, name), **kw)


def _read_output(spark: SparkSession, spec: SinkSpec) -> DataFrame:
    return _values(read_back(spark, spec, OUTPUT_SCHEMA))


# --- sources ------------------------------------------------------------------


_CSV_DONE: set[str] = set()


def _fixture_csv(spark: SparkSession, sf_dir: str, sep: str = ",") -> str:
    """The deliveries as CSV, white space kept; one comma (headed) and one semicolon copy per landed table.

    The files are compressed: a ``multiLine`` scan reads each in one task anyway.
    """
    source = land_deliveries(spark, sf_dir)
    path = f"{source}-csv-{'comma' if sep == ',' else 'semicolon'}-{spark.sparkContext.applicationId}"
    if path not in _CSV_DONE:
        (
            spark.read.schema(DELIVERY_SCHEMA).parquet(source).write.mode("overwrite")
            .option("header", sep == ",").option("sep", sep).option("quote", '"').option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("compression", "lz4").csv(path)
        )
        _CSV_DONE.add(path)
    return path


def q_csv_scan_typed(spark, sf_dir):
    return read_csv(spark, _fixture_csv(spark, sf_dir), header=True, schema=DELIVERY_SCHEMA)


def q_csv_scan_inferred(spark, sf_dir):
    path = _fixture_csv(spark, sf_dir)
    return read_csv(spark, path, header=True, schema=None, timestamp_format="yyyy-MM-dd'T'HH:mm:ss")


def q_csv_scan_delimited(spark, sf_dir):
    path = _fixture_csv(spark, sf_dir, ";")
    return read_csv(spark, path, header=False, schema=DELIVERY_SCHEMA, delimiter=";")


def q_deliveries_scan(spark, sf_dir):
    return read_deliveries(spark, _fixture_csv(spark, sf_dir))


def q_csv_scan_rejects(spark, sf_dir):
    """Deliveries as CSV lines, some damaged by their transport: which records the scan rejects, and what it still reads of them."""
    d = deliveries(spark, sf_dir).where("material IS NULL OR material NOT IN ('', '\"\"')").withColumn("t", F.substring("transporte", 2, 20).cast("long") % 5)
    line = F.to_csv(F.struct(*RAW_COLUMNS))
    no_price = F.to_csv(F.struct(*[F.lit("n/a").alias(c) if c == "precio" else F.col(c) for c in RAW_COLUMNS]))
    short, long = F.to_csv(F.struct(*RAW_COLUMNS[:5])), F.concat(line, F.lit(",more"))
    path = scratch_path(spark, "csv-rejects")
    d.select(F.when(F.col("t") == 0, no_price).when(F.col("t") == 1, short).when(F.col("t") == 2, long).otherwise(line).alias("value")).write.text(path)
    found = read_csv_with_rejects(spark, path, header=False, multiline=False)
    fields = F.when(F.col("rejected").isNotNull(), F.size(F.split("rejected", ",")))
    return found.groupBy("transporte", F.col("rejected").isNotNull().alias("is_rejected"), fields.cast("long").alias("fields")).agg(
        F.count("*").alias("rows"), F.count("precio").alias("prices"), F.count("cantidad").alias("quantities"), F.count("fecha_proceso").alias("dates"),
        F.sum("precio").cast("decimal(38,6)").alias("price_sum"),
    )


# --- sinks --------------------------------------------------------------------


def _sink_roundtrip(spark, sf_dir, name, **kw):
    spec = _spec(spark, name, **kw)
    write(_output(spark, sf_dir), spec)
    return _read_output(spark, spec)


def q_sink_parquet(spark, sf_dir):
    return _sink_roundtrip(spark, sf_dir, "sink-parquet", format="parquet", partition_column=None)


def q_sink_csv(spark, sf_dir):
    return _sink_roundtrip(spark, sf_dir, "sink-csv", format="csv")


def q_sink_json(spark, sf_dir):
    return _sink_roundtrip(spark, sf_dir, "sink-json", format="json")


def q_sink_partitioned(spark, sf_dir):
    return _sink_roundtrip(spark, sf_dir, "sink-partitioned", format="parquet")


def q_sink_partition_override(spark, sf_dir):
    spec = _spec(spark, "sink-override", format="parquet")
    write(_output(spark, sf_dir), spec, partition_by="country_code")
    return _read_output(spark, spec)


def q_sink_append(spark, sf_dir):
    spec = _spec(spark, "sink-append", format="parquet", mode="append")
    out = _output(spark, sf_dir)
    write(out, spec)
    write(out, spec)
    return _read_output(spark, spec)


def q_sink_overwrite(spark, sf_dir):
    spec = _spec(spark, "sink-overwrite", format="parquet", mode="overwrite")
    write(_output(spark, sf_dir), spec)
    write(_output(spark, sf_dir, LATER_START, LATER_END), spec)
    return _read_output(spark, spec)


def q_sink_ignore(spark, sf_dir):
    first = _spec(spark, "sink-ignore", format="parquet", mode="overwrite")
    write(_output(spark, sf_dir), first)
    second = SinkSpec(first.path, format="parquet", mode="ignore")
    write(_output(spark, sf_dir, LATER_START, LATER_END), second)
    return _read_output(spark, first)


def _refused(spark, write_call, spec, errors):
    """Whether a second write was refused, and the rows and dates that are there after it."""
    try:
        write_call()
        refused = False
    except errors:
        refused = True
    return _read_output(spark, spec).agg(
        F.lit(refused).alias("refused"), F.count("*").alias("rows"), F.countDistinct("process_date").alias("dates")
    )


def q_sink_error(spark, sf_dir):
    spec = _spec(spark, "sink-error", mode="error")
    write(_output(spark, sf_dir), spec)
    return _refused(spark, lambda: write(_output(spark, sf_dir, LATER_START, LATER_END), spec), spec, AnalysisException)


def q_sink_by_date_error(spark, sf_dir):
    spec = _spec(spark, "sink-by-date-error", mode="error")
    write_by_date(_output(spark, sf_dir, *FIRST_HALF), spec, schema=OUTPUT_SCHEMA)
    return _refused(spark, lambda: write_by_date(_output(spark, sf_dir, *SECOND_HALF), spec, schema=OUTPUT_SCHEMA), spec, SinkExistsError)


def q_sink_overwrite_failed(spark, sf_dir):
    """An overwrite that fails on one of its dates, the last that the tables hold; the rows that were there stay."""
    spec = _spec(spark, "sink-overwrite-failed")
    write(_output(spark, sf_dir), spec)
    late = _output(spark, sf_dir, LATER_START, LATER_END)
    last = late.agg(F.max("process_date")).first()[0]
    broken = late.withColumn("route_id", F.when(F.col("process_date") == last, F.raise_error(F.lit("lost its input"))).otherwise(F.col("route_id")))
    return _refused(spark, lambda: write(broken, spec), spec, PySparkException)


def q_sink_commits(spark, sf_dir):
    """The records of three write jobs: two appends and one that replaces its dates."""
    spec = _spec(spark, "sink-commits", mode="append")
    write(_output(spark, sf_dir), spec)
    write(_output(spark, sf_dir, LATER_START, LATER_END), spec)
    write_by_date(_output(spark, sf_dir, *FIRST_HALF), SinkSpec(spec.path))
    return commits(spark, spec.path).select("mode", "format", "partition_column", "rows", F.size("partitions").cast("long").alias("partition_values"))


def q_sink_rows_per_partition(spark, sf_dir):
    """Rows by date of a sink that two jobs filled, from its files' footers."""
    spec = _spec(spark, "sink-rows", mode="append")
    write(_output(spark, sf_dir), spec)
    write(_output(spark, sf_dir, LATER_START, LATER_END), spec)
    return stored_rows(spark, spec, schema=OUTPUT_SCHEMA)


def q_sink_csv_multiline(spark, sf_dir):
    spec = _spec(spark, "sink-csv-multiline", format="csv")
    out = _values(_output(spark, sf_dir)).withColumn("material_code", F.concat("material_code", F.lit("\nB")))
    write(out, spec)
    return _read_output(spark, spec)


def _by_date(spark, sf_dir, name, fmt="parquet", mode="overwrite"):
    """Two overlapping runs; the rows per date that the second one wrote."""
    spec = _spec(spark, name, format=fmt, mode=mode)
    write_by_date(_output(spark, sf_dir, *FIRST_HALF), spec, schema=OUTPUT_SCHEMA)
    per_dir = write_by_date(_output(spark, sf_dir, *SECOND_HALF), spec, schema=OUTPUT_SCHEMA)
    return per_dir.select("process_date", "rows")


def q_sink_by_date(spark, sf_dir):
    return _by_date(spark, sf_dir, "sink-by-date")


def q_sink_by_date_append(spark, sf_dir):
    return _by_date(spark, sf_dir, "sink-by-date-append", mode="append")


def q_sink_by_date_ignore(spark, sf_dir):
    return _by_date(spark, sf_dir, "sink-by-date-ignore", mode="ignore")


def q_sink_by_date_csv(spark, sf_dir):
    return _by_date(spark, sf_dir, "sink-by-date-csv", fmt="csv")


def q_sink_by_date_json(spark, sf_dir):
    return _by_date(spark, sf_dir, "sink-by-date-json", fmt="json")


# --- filters, de-duplication, expressions --------------------------------------


def q_drop_blank_material(spark, sf_dir):
    return drop_blank_material(deliveries(spark, sf_dir))


def q_filter_date_range(spark, sf_dir):
    return filter_date_range(deliveries(spark, sf_dir), START, END)


def q_filter_country(spark, sf_dir):
    return filter_country(deliveries(spark, sf_dir), COUNTRY.lower())


def q_filter_delivery_types(spark, sf_dir):
    return filter_delivery_types(deliveries(spark, sf_dir))


def q_drop_duplicates(spark, sf_dir):
    return drop_duplicates(deliveries(spark, sf_dir))


def q_fix_tiny_price(spark, sf_dir):
    return fix_tiny_price(deliveries(spark, sf_dir))


def q_convert_units(spark, sf_dir):
    return convert_units(deliveries(spark, sf_dir))


def q_convert_units_factor(spark, sf_dir):
    return convert_units(deliveries(spark, sf_dir), factor=10)


def q_classify_deliveries(spark, sf_dir):
    return classify_deliveries(deliveries(spark, sf_dir))


def q_classify_custom_types(spark, sf_dir):
    rules = DeliveryRules(
        routine_delivery_types=CUSTOM_ROUTINE, bonus_delivery_types=CUSTOM_BONUS
    )
    return classify_deliveries(
        deliveries(spark, sf_dir), rules.routine_delivery_types, rules.bonus_delivery_types
    )


def q_total_value(spark, sf_dir):
    d = convert_units(deliveries(spark, sf_dir))
    return d.withColumn("total_value", total_value("precio", "quantity_standardized"))


def q_unit_price(spark, sf_dir):
    return deliveries(spark, sf_dir).withColumn("unit_price", unit_price("precio", "cantidad"))


def q_quality_flag(spark, sf_dir):
    return deliveries(spark, sf_dir).withColumn(
        "data_quality_flag", quality_flag("precio", "cantidad", "material")
    )


def q_processing_timestamp(spark, sf_dir):
    """The timestamps in the written files: how many rows, values and nulls, and whether
    the one value is not older than the run's start."""
    started = spark.range(1).select(F.current_timestamp()).first()[0]
    result = run_delivery_job(deliveries(spark, sf_dir), RunParams(START, END, output=_spec(spark, "run-time"), profile_input=False))
    t = F.col("processing_timestamp")
    return result.written().agg(
        F.count("*").alias("rows"), F.countDistinct(t).alias("timestamps"), F.count_if(t.isNull()).alias("nulls"),
        F.bool_and(t >= F.lit(started)).alias("not_before_start"),
    )


def q_parse_process_date(spark, sf_dir):
    return deliveries(spark, sf_dir).select(
        "fecha_proceso", parse_process_date("fecha_proceso").alias("process_day")
    )


def q_rename_standard(spark, sf_dir):
    return rename_to_standard(deliveries(spark, sf_dir))


def q_select_final(spark, sf_dir):
    d = deliveries(spark, sf_dir)
    d = add_calculated_columns(classify_deliveries(convert_units(d)), with_timestamp=False)
    return select_final(rename_to_standard(d))


def q_enrich_deliveries(spark, sf_dir):
    d = convert_units(clean(deliveries(spark, sf_dir)))
    return add_calculated_columns(d, with_timestamp=False)


# --- composite ------------------------------------------------------------------


def q_clean_deliveries(spark, sf_dir):
    return clean(deliveries(spark, sf_dir))


def q_clean_all_off(spark, sf_dir):
    return clean(
        deliveries(spark, sf_dir),
        remove_empty_material=False,
        remove_duplicates=False,
        fix_scientific_notation=False,
    )


def q_delivery_transform(spark, sf_dir):
    return transform(deliveries(spark, sf_dir), START, END, with_timestamp=False)


def q_delivery_transform_country(spark, sf_dir):
    return transform(deliveries(spark, sf_dir), START, END, country=COUNTRY, with_timestamp=False)


def q_delivery_transform_keep_all_types(spark, sf_dir):
    return transform(
        deliveries(spark, sf_dir),
        START,
        END,
        quality={"filter_valid_delivery_types": False},
        with_timestamp=False,
    )


def q_run_delivery_job(spark, sf_dir):
    params = RunParams(START, END, output=_spec(spark, "run-job", format="parquet"))
    result = run_delivery_job(deliveries(spark, sf_dir), params)
    return _values(result.written())


def q_run_delivery_job_csv(spark, sf_dir):
    """CSV in, files out; the fixture's fields hold no line breaks, so its files are split."""
    params = RunParams(START, END, output=_spec(spark, "run-job-csv", format="parquet"), multiline=False)
    return _values(run_delivery_job_from_csv(spark, _fixture_csv(spark, sf_dir), params).written())


def _metrics(spark, sf_dir, name, mode, second):
    spec = _spec(spark, name, mode=mode)
    source = deliveries(spark, sf_dir)
    run_delivery_job(source, RunParams(START, END, output=spec, profile_input=False))
    result = run_delivery_job(source, RunParams(*second, output=spec, profile_input=False))
    return result.metrics().select("output_format", "rows_written", "partition_values")


def q_run_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir, "run-metrics", "overwrite", (LATER_START, LATER_END))


def q_run_metrics_append(spark, sf_dir):
    return _metrics(spark, sf_dir, "run-metrics-append", "append", (LATER_START, LATER_END))


def q_run_metrics_ignore(spark, sf_dir):
    return _metrics(spark, sf_dir, "run-metrics-ignore", "ignore", (LATER_START, LATER_END))


def _reported_run(spark, sf_dir, name):
    params = RunParams(START, END, output=_spec(spark, name), country=COUNTRY.lower())
    return run_delivery_job(deliveries(spark, sf_dir), params)


def q_run_input_profile(spark, sf_dir):
    return _reported_run(spark, sf_dir, "run-profile").input_profile()


def q_run_funnel(spark, sf_dir):
    return _reported_run(spark, sf_dir, "run-funnel").funnel()


def q_run_rows_per_partition(spark, sf_dir):
    return _reported_run(spark, sf_dir, "run-rows").rows_per_partition()


def q_run_over_own_output(spark, sf_dir):
    """A run over an earlier run's files, for the dates of the second half."""
    spec = _spec(spark, "run-first")
    run_delivery_job(deliveries(spark, sf_dir), RunParams(START, END, output=spec, profile_input=False))
    earlier = from_standard(read_back(spark, spec, OUTPUT_SCHEMA))
    again = RunParams(*SECOND_HALF, output=_spec(spark, "run-again"), profile_input=False)
    return _values(run_delivery_job(earlier, again).written())


# --- profiles and audits ----------------------------------------------------------


def q_profile_values(spark, sf_dir):
    return profile_values(deliveries(spark, sf_dir))


def q_profile_rows(spark, sf_dir):
    return profile_rows(deliveries(spark, sf_dir))


def q_rows_per_partition(spark, sf_dir):
    return rows_per_partition(_output(spark, sf_dir), "process_date")


def q_output_summary(spark, sf_dir):
    return output_summary(_output(spark, sf_dir), "process_date")


def q_cleaning_funnel(spark, sf_dir):
    return cleaning_funnel(deliveries(spark, sf_dir), START, END, country=COUNTRY.lower())


def q_audit_bad_dates(spark, sf_dir):
    return audit_bad_dates(deliveries(spark, sf_dir))


def q_audit_bad_countries(spark, sf_dir):
    return audit_bad_countries(deliveries(spark, sf_dir))


def q_audit_bad_countries_custom(spark, sf_dir):
    return audit_bad_countries(deliveries(spark, sf_dir), CODES_WITHOUT_JM)


def q_audit_countries_table(spark, sf_dir):
    """Against the first two letters of the nations' names."""
    codes = table(spark, sf_dir, "nation").select(F.substring("n_name", 1, 2).alias("code"))
    return audit_countries_table(deliveries(spark, sf_dir), codes)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
