"""Plan checks: shuffles, pushdown, pruning, no Python in the plan."""

import re

from cargoline.plans.transform import transform
from cargoline.sinks import SinkSpec, write
from cargoline.sources.csv import read_deliveries
from cargoline.schema import OUTPUT_SCHEMA


def plan_text(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def test_one_shuffle_over_a_csv_scan(spark, sample, tmp_path, capsys):
    path = str(tmp_path / "in")
    sample.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    out = transform(read_deliveries(spark, path), "2025-01-01", "2025-12-31", country="GT")
    text = plan_text(out, capsys)
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_filters_reach_the_parquet_scan(spark, sample, tmp_path, capsys):
    path = str(tmp_path / "p")
    sample.write.parquet(path)
    out = transform(spark.read.parquet(path), "2025-01-01", "2025-06-30")
    text = plan_text(out, capsys)
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "In(tipo_entrega" in pushed
    assert "GreaterThanOrEqual(fecha_proceso,20250101)" in pushed
    assert "LessThanOrEqual(fecha_proceso,20250630)" in pushed


def test_date_range_prunes_partitions_on_read_back(spark, sample, tmp_path, capsys):
    from cargoline.operators.filters import filter_date_range
    from pyspark.sql import functions as F

    spec = SinkSpec(str(tmp_path / "o"))
    write(transform(sample, "2025-01-01", "2025-12-31"), spec)
    back = spark.read.schema(OUTPUT_SCHEMA).parquet(spec.path)
    sel = filter_date_range(back, "2025-04-01", "2025-06-01", column="process_date")
    text = plan_text(sel, capsys)
    assert re.search(r"PartitionFilters: \[.*process_date.*\]", text)
    assert sel.count() == 2
    assert sel.agg(F.countDistinct("process_date")).first()[0] == 2


def test_dedup_is_partial_then_final(spark, sample, capsys):
    text = plan_text(transform(sample, "2025-01-01", "2025-12-31"), capsys)
    assert text.count("HashAggregate") >= 2


def test_sink_observation_keeps_pushdown(spark, sample, tmp_path, capsys):
    """The run job counts written rows with an Observation at the sink; the
    filters below it must still reach the scan."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    path = str(tmp_path / "p")
    sample.write.parquet(path)
    out = transform(spark.read.parquet(path), "2025-01-01", "2025-06-30")
    observed = out.observe(Observation("rows"), F.count(F.lit(1)).alias("rows"))
    text = plan_text(observed.hint("rebalance", "process_date"), capsys)
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "In(tipo_entrega" in pushed and "GreaterThanOrEqual(fecha_proceso" in pushed
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 2  # dedup + rebalance
