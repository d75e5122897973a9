"""Commit records, writes that fail midway, one scan a run, rejects and pruned reruns."""

import os
import re
from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cargoline import storage
from cargoline.operators.audit import audit_countries_table
from cargoline.operators.profile import cleaning_funnel, profile_values, with_multiplicity
from cargoline.plans.run import RunParams, run_delivery_job, take_in
from cargoline.plans.transform import QualityChecks, from_standard, standardize, transform
from cargoline.schema import OUTPUT_SCHEMA, RAW_COLUMNS
from cargoline.sinks import SinkSpec, read_back, write, write_by_date
from cargoline.sinks.commits import commits
from cargoline.sinks.files import commit_write, stored_rows
from cargoline.sources.csv import read_csv_with_rejects
from tests.conftest import rows

YEAR = ("2025-01-01", "2025-12-31")


def plan_text(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def test_records_tell_what_each_job_committed(spark, sample, tmp_path):
    out = transform(sample, *YEAR)
    spec = SinkSpec(str(tmp_path / "o"), mode="append")
    first, second = commit_write(out, spec), commit_write(out.where("country_code = 'GT'"), spec)
    assert (first.rows, first.partitions) == (5, ("20250307", "20250418", "20250526", "20250830"))
    assert (second.rows, second.partitions) == (2, ("20250307",))
    assert read_back(spark, spec, OUTPUT_SCHEMA, second).count() == 2
    assert read_back(spark, spec, OUTPUT_SCHEMA, first).count() == 5
    assert read_back(spark, spec, OUTPUT_SCHEMA).count() == 7  # records are no data
    assert sorted((r.mode, r.rows, len(r.partitions)) for r in commits(spark, spec.path).collect()) == [("append", 2, 1), ("append", 5, 4)]
    third = commit_write(out, SinkSpec(spec.path))
    assert [(r.job, r.mode) for r in commits(spark, spec.path).collect()] == [(third.job, "overwrite")]
    assert commits(spark, str(tmp_path / "none")).count() == 0


def test_files_of_another_writer_do_not_count(spark, sample, tmp_path):
    out = transform(sample, *YEAR)
    spec = SinkSpec(str(tmp_path / "o"), mode="append")
    result = run_delivery_job(sample, RunParams(*YEAR, output=spec))
    out.write.mode("append").partitionBy("process_date").parquet(spec.path)
    assert result.rows_written == result.written().count() == 5
    assert sum(r.rows for r in result.rows_per_partition().collect()) == 5


def test_no_listing_of_the_sink(spark, sample, tmp_path, monkeypatch):
    def stop(*_):
        raise AssertionError("the sink was listed")

    monkeypatch.setattr(storage, "files", stop)
    for mode in ("append", "overwrite", "ignore"):
        result = run_delivery_job(sample, RunParams(*YEAR, output=SinkSpec(str(tmp_path / "o"), mode=mode)))
        assert result.metrics().count() == 1 and result.rows_written == (0 if mode == "ignore" else 5)
    for mode in ("overwrite", "append", "ignore", "error"):
        write_by_date(transform(sample, *YEAR), SinkSpec(str(tmp_path / mode), mode=mode))


@pytest.mark.parametrize("partition_column", ["process_date", None])
@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_failed_overwrite_leaves_the_old_rows(spark, sample, tmp_path, fmt, partition_column):
    out = transform(sample, *YEAR)
    spec = SinkSpec(str(tmp_path / "o"), format=fmt, partition_column=partition_column)
    schema = OUTPUT_SCHEMA if partition_column else out.schema
    write(out, spec)
    broken = out.withColumn("route_id", F.when(F.col("country_code") == "JM", F.raise_error(F.lit("lost"))).otherwise(F.col("route_id")))
    with pytest.raises(PySparkException):
        write(broken, spec)
    assert read_back(spark, spec, schema).count() == 5 and commits(spark, spec.path).count() == 1
    write(out.where("country_code = 'JM'"), spec)
    assert [r.country_code for r in read_back(spark, spec, schema).collect()] == ["JM"]
    write(out.limit(0), spec)
    assert read_back(spark, spec, schema).count() == 0


def test_escaped_and_null_partition_values(spark, tmp_path):
    df = spark.createDataFrame([("a/b c", 1), (None, 2), ("", 3), ("ü=%", 4), ("x", 5)], "process_date string, n int")
    spec = SinkSpec(str(tmp_path / "o"))
    commit = commit_write(df, spec)
    assert commit.rows == 5 and sorted(r.n for r in read_back(spark, spec, df.schema, commit).collect()) == [1, 2, 3, 4, 5]
    assert {os.path.basename(f) for f in commit.folders(spark)} == {d for d in os.listdir(spec.path) if "=" in d}
    assert set(storage.partition_values(spark, spec.path, "process_date")) == {"a/b c", None, "ü=%", "x"}


def test_a_run_scans_its_input_once(spark, sample, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    result = run_delivery_job(sample.mapInArrow(count, sample.schema), RunParams(*YEAR, country="gt", output=SinkSpec(str(tmp_path / "o"))))
    assert result.input_info["total_records"] == 10 and result.input_info["distinct_values"] == {"pais": 4, "fecha_proceso": 5, "tipo_entrega": 5}
    funnel = sorted(map(tuple, result.funnel().collect()))
    assert result.written().count() == 2 and result.summary().count() == 1
    assert read.value == 10
    assert funnel == sorted(map(tuple, cleaning_funnel(sample, *YEAR, country="gt").collect()))
    assert [r[2] for r in funnel] == [10, 8, 7, 6, 5, 2]
    assert sorted(map(repr, result.input_profile().collect())) == sorted(map(repr, profile_values(sample).collect()))


@pytest.mark.parametrize("switches", [{}, {"remove_duplicates": False}, {"remove_empty_material": False}, {"fix_scientific_notation": False, "filter_valid_delivery_types": False}])
def test_runs_with_and_without_reports_write_alike(spark, sample, tmp_path, switches):
    quality = QualityChecks.of(switches)
    kept = [
        sorted(map(repr, run_delivery_job(sample, RunParams(*YEAR, output=SinkSpec(str(tmp_path / str(p))), quality=quality, profile_input=p)).written().drop("processing_timestamp").collect()))
        for p in (True, False)
    ]
    assert kept[0] == kept[1]
    result = run_delivery_job(sample, RunParams(*YEAR, output=SinkSpec(str(tmp_path / "f")), quality=quality))
    steps = {r.stage: r.rows for r in result.funnel().collect()}
    assert steps["in_date_range"] == result.rows_written and steps["read"] == 10


def test_one_exchange_feeds_rows_and_reports(spark, sample, tmp_path, capsys):
    path = str(tmp_path / "in")
    sample.write.parquet(path)
    source = spark.read.parquet(path)
    assert len(re.findall(r"^\(\d+\) Exchange", plan_text(with_multiplicity(source), capsys), re.M)) == 1
    intake = take_in(source, QualityChecks())
    out = plan_text(standardize(intake.where("NOT dropped").select(*RAW_COLUMNS), *YEAR), capsys)
    assert "Exchange" not in out and "In(tipo_entrega" in out and "GreaterThanOrEqual(fecha_proceso" in out


def test_empty_type_list_means_the_defaults(spark, sample):
    assert cleaning_funnel(sample, *YEAR, valid_types=[]).collect() == cleaning_funnel(sample, *YEAR).collect()


def test_stored_rows_read_no_column(spark, sample, tmp_path, capsys):
    spec = SinkSpec(str(tmp_path / "o"))
    write(transform(sample, *YEAR), spec)
    found = stored_rows(spark, spec, schema=OUTPUT_SCHEMA)
    assert "ReadSchema: struct<>" in plan_text(found, capsys)
    assert {r.process_date: r.rows for r in found.collect()} == {"20250307": 2, "20250418": 1, "20250526": 1, "20250830": 1}


def test_a_run_over_its_own_output_prunes_folders(spark, sample, tmp_path, capsys):
    spec = SinkSpec(str(tmp_path / "o"))
    write(transform(sample, *YEAR), spec)
    earlier = from_standard(read_back(spark, spec, OUTPUT_SCHEMA))
    again = transform(earlier, "2025-04-01", "2025-06-01")
    assert re.search(r"PartitionFilters: \[.*process_date.*>= 20250401.*\]", plan_text(again, capsys))
    want = transform(sample, "2025-04-01", "2025-06-01")
    assert sorted(map(repr, again.drop("processing_timestamp").collect())) == sorted(map(repr, want.drop("processing_timestamp").collect()))


@pytest.mark.parametrize("multiline", [True, False])
def test_rejects_tell_unreadable_from_empty(spark, tmp_path, multiline):
    lines = [
        "pais,fecha_proceso,transporte,ruta,tipo_entrega,material,precio,cantidad,unidad",
        "GT,20250101,T,R,ZPRE,M,1.5,2,ST", "GT,20250101,T,R,ZPRE,M,,2,ST", "GT,20250101,T,R,ZPRE,M,n/a,2,ST", "GT,20250101,T", "GT,20250101,T,R,ZPRE,M,1.5,2,ST,more",
    ]
    path = tmp_path / "x.csv"
    path.write_text("\n".join(lines) + "\n")
    found = read_csv_with_rejects(spark, str(path), multiline=multiline)
    got = [(r.pais, r.precio, r.cantidad, r.rejected) for r in found.collect()]
    assert got == [("GT", D("1.5"), 2, None), ("GT", None, 2, None), ("GT", None, 2, lines[3]), ("GT", None, None, lines[4]), ("GT", D("1.5"), 2, lines[5])]
    # the verdict is the same whatever else is asked for
    assert found.where("rejected IS NOT NULL").select("pais").count() == 3
    assert found.where("rejected IS NOT NULL").count() == 3


def test_countries_against_a_table(spark, capsys):
    data = [(c, "20250101", "T", "R", "ZPRE", "M", D(1), D(1), "ST") for c in ("GT", "gt", "XX", "XX", None, "pe")]
    df = rows(spark, data)
    codes = spark.createDataFrame([("gt",), (None,), ("PE",), ("PE",)], "code string")
    assert {r.value: r.rows for r in audit_countries_table(df, codes).collect()} == {"XX": 2}
    assert audit_countries_table(df, codes.limit(0)).count() == 4
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        assert "SortMergeJoin" in plan_text(audit_countries_table(df, codes), capsys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
