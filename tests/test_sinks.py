import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cargoline.plans.transform import transform
from cargoline.schema import OUTPUT_SCHEMA
from cargoline.sinks import SinkExistsError, SinkSpec, read_back, write, write_by_date


@pytest.fixture
def output(sample):
    return transform(sample, "2025-01-01", "2025-12-31")


def _values(df):
    return sorted(tuple(r) for r in df.drop("processing_timestamp").select(sorted(df.drop("processing_timestamp").columns)).collect())


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "PARQUET"])
def test_round_trip_values(spark, output, tmp_path, fmt):
    spec = SinkSpec(str(tmp_path / "out"), format=fmt)
    assert write(output, spec) == spec.path
    back = read_back(spark, spec, OUTPUT_SCHEMA)
    assert _values(back) == _values(output)
    dirs = sorted(d for d in os.listdir(spec.path) if d.startswith("process_date="))
    assert dirs == ["process_date=20250307", "process_date=20250418",
                    "process_date=20250526", "process_date=20250830"]


def test_partition_override_and_absent_column(spark, output, tmp_path):
    spec = SinkSpec(str(tmp_path / "a"))
    write(output, spec, partition_by="country_code")
    assert sorted(d for d in os.listdir(spec.path) if "=" in d) == [
        "country_code=EC", "country_code=GT", "country_code=HN", "country_code=JM"]
    flat = SinkSpec(str(tmp_path / "b"), partition_column="nope")
    write(output, flat)
    assert not any("=" in d for d in os.listdir(flat.path))
    assert read_back(spark, flat).count() == 5


def test_modes(spark, output, tmp_path):
    path = str(tmp_path / "m")
    write(output, SinkSpec(path, mode="append"))
    write(output, SinkSpec(path, mode="append"))
    assert read_back(spark, SinkSpec(path)).count() == 10
    write(output.filter("process_date = '20250307'"), SinkSpec(path, mode="overwrite"))
    # static overwrite: partitions not in this run are gone
    assert read_back(spark, SinkSpec(path)).count() == 2
    write(output, SinkSpec(path, mode="ignore"))
    assert read_back(spark, SinkSpec(path)).count() == 2
    with pytest.raises(AnalysisException) as caught:
        write(output, SinkSpec(path, mode="error"))
    assert caught.value.getCondition() == "PATH_ALREADY_EXISTS"


def test_unsupported_format_raises_before_any_job():
    with pytest.raises(ValueError):
        SinkSpec("/nowhere", format="xml")
    with pytest.raises(ValueError):
        SinkSpec("/nowhere", mode="merge")


def test_write_by_date_dynamic_overwrite(spark, output, tmp_path):
    spec = SinkSpec(str(tmp_path / "d"))
    first = write_by_date(output, spec, schema=OUTPUT_SCHEMA)
    assert {r.process_date: r.rows for r in first.collect()} == {
        "20250307": 2, "20250418": 1, "20250526": 1, "20250830": 1}
    assert all(r.path.endswith(f"process_date={r.process_date}") for r in first.collect())
    # a second run with one date replaces only that date
    again = output.filter("process_date = '20250307'").limit(1)
    got = {r.process_date: r.rows for r in write_by_date(again, spec, schema=OUTPUT_SCHEMA).collect()}
    assert got == {"20250307": 1}
    assert read_back(spark, spec, OUTPUT_SCHEMA).count() == 4


def test_write_by_date_ignore_and_error(spark, output, sample, tmp_path):
    spec = SinkSpec(str(tmp_path / "e"))
    write_by_date(output.filter("process_date <> '20250830'"), spec, schema=OUTPUT_SCHEMA)
    ign = SinkSpec(spec.path, mode="ignore")
    got = {r.process_date: r.rows for r in write_by_date(output, ign, schema=OUTPUT_SCHEMA).collect()}
    assert got == {"20250830": 1}
    with pytest.raises(SinkExistsError):
        write_by_date(output, SinkSpec(spec.path, mode="error"), schema=OUTPUT_SCHEMA)
    fresh = SinkSpec(str(tmp_path / "f"), mode="error")
    assert write_by_date(output, fresh, schema=OUTPUT_SCHEMA).count() == 4


def test_write_by_date_null_date_goes_to_default_partition(spark, output, tmp_path):
    spec = SinkSpec(str(tmp_path / "n"))
    df = output.withColumn("process_date", F.when(F.col("material_code") == "FREE5", None)
                           .otherwise(F.col("process_date")))
    got = {r.process_date: r.path for r in write_by_date(df, spec, schema=OUTPUT_SCHEMA).collect()}
    assert got[None].endswith("__HIVE_DEFAULT_PARTITION__")


def test_csv_sink_keeps_quotes_commas_and_newlines(spark, tmp_path):
    from decimal import Decimal as D

    from cargoline.schema import DELIVERY_SCHEMA
    from cargoline.sources.csv import read_deliveries

    data = [("GT", "20250101", 'T"1', "R,1", "ZPRE", "line\nbreak", D("1.5"), D(2), "ST")]
    df = spark.createDataFrame(data, DELIVERY_SCHEMA)
    spec = SinkSpec(str(tmp_path / "c"), format="csv", partition_column=None)
    write(df, spec)
    back = read_deliveries(spark, spec.path).collect()
    assert [tuple(r) for r in back] == data


def test_text_edge_values_per_format(spark, tmp_path):
    """CSV loses '' vs NULL and trims outer spaces by default; JSON and
    Parquet keep both; partition values are escaped in paths."""
    df = spark.createDataFrame(
        [("a/b", "", " x "), ("c", None, "   ")], "process_date string, t string, u string"
    )
    got = {}
    for fmt in ("parquet", "json", "csv"):
        spec = SinkSpec(str(tmp_path / fmt), format=fmt)
        write(df, spec)
        back = read_back(spark, spec, "t string, u string, process_date string")
        got[fmt] = sorted((r.process_date, r.t, r.u) for r in back.collect())
    assert got["parquet"] == got["json"] == [("a/b", "", " x "), ("c", None, "   ")]
    assert got["csv"] == [("a/b", None, "x"), ("c", None, None)]
    assert "process_date=a%2Fb" in os.listdir(str(tmp_path / "parquet"))


def test_rebalance_keeps_one_file_set_per_date(spark, output, tmp_path, capsys):
    spec = SinkSpec(str(tmp_path / "r"))
    capsys.readouterr()
    output.hint("rebalance", "process_date").explain()
    assert "REBALANCE_PARTITIONS_BY_COL" in capsys.readouterr().out
    write(output, spec)
    for d in os.listdir(spec.path):
        if d.startswith("process_date="):
            files = [f for f in os.listdir(os.path.join(spec.path, d)) if f.endswith(".parquet")]
            assert len(files) == 1


def test_sink_defaults_and_custom_values(tmp_path):
    spec = SinkSpec(str(tmp_path))
    assert (spec.format, spec.partition_column, spec.mode, spec.compression) == (
        "parquet", "process_date", "overwrite", "snappy")
    custom = SinkSpec(str(tmp_path), format="CSV", partition_column="country_code",
                      mode="append", compression="gzip")
    assert (custom.format, custom.partition_column, custom.mode, custom.compression) == (
        "csv", "country_code", "append", "gzip")


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_write_by_date_text_formats(spark, output, tmp_path, fmt):
    spec = SinkSpec(str(tmp_path / fmt), format=fmt)
    got = {r.process_date: r.rows for r in write_by_date(output, spec, schema=OUTPUT_SCHEMA).collect()}
    assert got == {"20250307": 2, "20250418": 1, "20250526": 1, "20250830": 1}
    back = read_back(spark, spec, OUTPUT_SCHEMA)
    assert _values(back) == _values(output)


def test_write_by_date_empty_frame_and_default_schema(spark, tmp_path):
    empty = spark.createDataFrame([], "process_date string, x int")
    assert write_by_date(empty, SinkSpec(str(tmp_path / "e"))).count() == 0
    df = spark.createDataFrame([("20250101", 1), ("20250102", 2)], "process_date string, x int")
    got = write_by_date(df, SinkSpec(str(tmp_path / "d"))).collect()
    assert sorted((r.process_date, r.rows) for r in got) == [("20250101", 1), ("20250102", 1)]


def test_csv_read_back_keeps_line_breaks_and_counts(spark, tmp_path):
    df = spark.createDataFrame([("20250101", "A\nB"), ("20250101", "c"), ("20250102", "d")], "process_date string, x string")
    spec = SinkSpec(str(tmp_path / "c"), format="csv")
    got = {r.process_date: r.rows for r in write_by_date(df, spec).collect()}
    assert got == {"20250101": 2, "20250102": 1}
    assert {r.x for r in read_back(spark, spec, "x string, process_date string").collect()} == {"A\nB", "c", "d"}
