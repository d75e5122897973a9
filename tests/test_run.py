"""Run job (X4), argument checks (V1, V2), profiles (P1, P2) and audits."""

import pytest

from cargoline.operators.audit import audit_bad_countries, audit_bad_dates
from cargoline.operators.profile import dataset_info, output_summary, profile_values, rows_per_partition
from cargoline.plans.run import RunParams, run_delivery_job, run_delivery_job_from_csv
from cargoline.sinks import SinkSpec
from tests.conftest import rows
from decimal import Decimal as D


@pytest.mark.parametrize(
    "start,end,country",
    [("2025/01/01", "2025-12-31", None), ("2025-02-30", "2025-12-31", None),
     ("2025-12-31", "2025-01-01", None), ("2025-01-01", "2025-12-31", "XX"),
     ("2025-01-01", "20251231", None)],
)
def test_bad_arguments_raise_before_any_job(start, end, country, tmp_path):
    with pytest.raises(ValueError):
        RunParams(start, end, output=SinkSpec(str(tmp_path)), country=country).check()


@pytest.mark.parametrize("code", ["GT", "PE", "EC", "SV", "HN", "JM", "gt", "jm"])
def test_valid_countries(code, tmp_path):
    RunParams("2025-01-01", "2025-12-31", output=SinkSpec(str(tmp_path)), country=code).check()


def test_run_job_writes_reads_back_and_reports(spark, sample, tmp_path):
    params = RunParams("2025-01-01", "2025-12-31", output=SinkSpec(str(tmp_path / "out")))
    result = run_delivery_job(sample, params)
    assert result.rows_written == 5
    back = result.written()
    assert back.count() == 5
    assert back.filter("processing_timestamp IS NULL").count() == 0
    assert {r.process_date: r.rows for r in result.rows_per_partition().collect()} == {
        "20250307": 2, "20250418": 1, "20250526": 1, "20250830": 1}
    m = result.metrics().first()
    assert (m.rows_written, m.partition_values, m.output_format) == (5, 4, "parquet")


def test_run_job_from_csv_with_country(spark, sample, tmp_path):
    src = str(tmp_path / "in")
    sample.write.option("header", True).option("quote", '"').option("escape", '"').csv(src)
    params = RunParams("2025-01-01", "2025-12-31", country="gt",
                       output=SinkSpec(str(tmp_path / "out"), format="json"))
    assert run_delivery_job_from_csv(spark, src, params).rows_written == 2


def test_profile_and_info(spark, sample):
    vals = {(r.column_name, r.value): r.rows for r in profile_values(sample).collect()}
    assert vals[("pais", "GT")] == 7 and vals[("tipo_entrega", "COBR")] == 1
    info = dataset_info(sample)
    assert info["total_records"] == 10
    assert info["distinct_values"] == {"pais": 4, "fecha_proceso": 5, "tipo_entrega": 5}
    assert info["columns"][0] == "pais" and "decimal(38,18)" in info["schema"]
    bare = spark.createDataFrame([("a", 1)], "col1 string, col2 bigint")
    assert profile_values(bare).count() == 0
    assert dataset_info(bare)["total_records"] == 1


def test_summaries(spark, sample):
    from pyspark.sql import functions as F

    df = sample.withColumn("process_date", F.col("fecha_proceso"))
    assert {r.process_date: r.rows for r in rows_per_partition(df).collect()}["20250307"] == 6
    s = output_summary(df).first()
    assert (s.total_records, s.partition_values) == (10, 5)
    assert output_summary(sample).first().total_records == 10


def test_audits(spark):
    data = [(c, d, "T", "R", "ZPRE", "M", D(1), D(1), "ST")
            for c, d in [("GT", "20250101"), ("gt", "2025-01-01"), ("XX", None), (None, "bad"),
                         ("XX", "20250230")]]
    df = rows(spark, data)
    assert {r.value: r.rows for r in audit_bad_dates(df).collect()} == {
        "2025-01-01": 1, "bad": 1, "20250230": 1}
    assert {r.value: r.rows for r in audit_bad_countries(df).collect()} == {"XX": 2}
    assert {r.value: r.rows for r in audit_bad_countries(df, ["XX"]).collect()} == {"GT": 1, "gt": 1}


def test_settings_tree_like_the_original_yaml(spark, sample, tmp_path):
    import yaml

    from cargoline.plans.run import run_from_mapping

    src = str(tmp_path / "in")
    sample.write.option("header", True).option("quote", '"').option("escape", '"').csv(src)
    cfg = yaml.safe_load(f"""
paths:
  input_file: "{src}"
  output_base: "{tmp_path / 'out'}"
filters:
  start_date: "2025-01-01"
  end_date: "2025-12-31"
  country: null
transformations:
  unit_conversion: {{cs_to_st_factor: 10, standard_unit: "ST"}}
  delivery_types: {{routine: ["ZPRE", "ZVE1"], bonus: ["Z04", "Z05"]}}
data_quality:
  remove_empty_material: true
  remove_duplicates: true
  fix_scientific_notation: true
  filter_valid_delivery_types: true
spark:
  config: {{spark.sql.shuffle.partitions: "4"}}
output: {{format: "parquet", mode: "overwrite", partition_column: "process_date", compression: "snappy"}}
""")
    params = RunParams.from_mapping(cfg)
    assert params.rules.cs_to_st_factor == 10 and params.country is None
    result = run_from_mapping(spark, cfg)
    assert result.rows_written == 5
    got = {r.material_code: r.quantity_standardized for r in result.written().collect()}
    assert got["CRATE2"] == D(30)


def test_optional_input_profile(spark, sample, tmp_path):
    params = RunParams("2025-01-01", "2025-12-31", output=SinkSpec(str(tmp_path / "o")),
                       profile_input=True)
    info = run_delivery_job(sample, params).input_info
    assert info["total_records"] == 10 and info["distinct_values"]["pais"] == 4


def test_settings_tree_defaults_and_overrides(tmp_path):
    base = {"filters": {"start_date": "2025-01-01", "end_date": "2025-06-30"},
            "paths": {"output_base": str(tmp_path)}}
    p = RunParams.from_mapping(base)
    assert p.country is None and p.rules.cs_to_st_factor == 20
    assert p.rules.valid_delivery_types == ("ZPRE", "ZVE1", "Z04", "Z05")
    assert p.quality.remove_duplicates and p.quality.filter_valid_delivery_types
    assert (p.output.format, p.output.mode, p.output.partition_column, p.output.compression) == (
        "parquet", "overwrite", "process_date", "snappy")
    p.check()

    tree = dict(base, data_quality={}, filters=dict(base["filters"], country="pe"),
                output={"format": "JSON", "mode": "append"})
    q = RunParams.from_mapping(tree)
    assert q.quality == RunParams.from_mapping(base).quality  # empty section: all on
    assert q.country == "pe" and (q.output.format, q.output.mode) == ("json", "append")
    q.check()

    off = RunParams.from_mapping(dict(base, data_quality={"remove_duplicates": False}))
    assert off.quality.remove_duplicates is False and off.quality.remove_empty_material is True


def test_settings_tree_missing_dates_fail_the_check(tmp_path):
    with pytest.raises(ValueError):
        RunParams.from_mapping({"paths": {"output_base": str(tmp_path)}}).check()


def test_reports_cover_this_run_only(spark, sample, tmp_path):
    first = SinkSpec(str(tmp_path / "o"), mode="append")
    run_delivery_job(sample, RunParams("2025-01-01", "2025-12-31", output=first))
    again = run_delivery_job(sample, RunParams("2025-03-01", "2025-03-31", output=first)).summary().first()
    assert (again.total_records, again.partition_values) == (2, 1)
    skipped = run_delivery_job(sample, RunParams("2025-01-01", "2025-12-31", output=SinkSpec(first.path, mode="ignore")))
    assert skipped.rows_written == 0 and skipped.metrics().first().partition_values == 0


def test_early_start_date(spark, sample, tmp_path):
    spec = SinkSpec(str(tmp_path / "e"))
    assert run_delivery_job(sample, RunParams("0001-01-01", "2025-12-31", output=spec)).rows_written == 6


def test_splittable_csv_reads_in_several_partitions(spark, tmp_path):
    from cargoline.sources.csv import read_deliveries

    path = str(tmp_path / "big")
    spark.range(40000).selectExpr("'GT' a", "'20250101' b", "'T' c", "'R' d", "'ZPRE' e", "cast(id as string) f", "1 g", "1 h", "'ST' i").coalesce(1).write.option(
        "header", True).csv(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
        assert read_deliveries(spark, path, multiline=False).rdd.getNumPartitions() > 1
        assert read_deliveries(spark, path).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_intake_tasks_read_small_splits(spark, tmp_path, monkeypatch):
    """The tasks that de-duplicate the input hold a bounded part of it; the session's setting stays."""
    from pyspark.sql import functions as F

    from cargoline.plans import run
    from cargoline.plans.transform import QualityChecks
    from cargoline.schema import DELIVERY_SCHEMA
    from cargoline.sources.fixture import deliveries
    from tests.conftest import SF_SMALL

    path = str(tmp_path / "in")
    deliveries(spark, SF_SMALL).coalesce(1).write.option("parquet.block.size", 8192).parquet(path)  # many row groups
    source = spark.read.schema(DELIVERY_SCHEMA).parquet(path).withColumn("ruta", F.spark_partition_id().cast("string"))
    own = spark.conf.get(run.SPLIT)
    whole = run.take_in(source, QualityChecks()).select("ruta").distinct().count()
    monkeypatch.setattr(run, "SPLIT_BYTES", 8192)
    intake = run.take_in(source, QualityChecks())
    assert intake.select("ruta").distinct().count() > whole
    assert intake.agg(F.sum("m")).first()[0] == 7217
    assert spark.conf.get(run.SPLIT) == own
