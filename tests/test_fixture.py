"""The deliveries table derived from the test tables, and its landed copy."""

from pyspark.sql import functions as F

from cargoline.schema import DELIVERY_SCHEMA
from cargoline.sources import fixture
from cargoline.sources.fixture import deliveries, derive_deliveries, land_deliveries
from tests.conftest import SF_SMALL


def test_derivation_counts(spark):
    d = derive_deliveries(spark, SF_SMALL)
    assert [(f.name, f.dataType) for f in d.schema] == [
        (f.name, f.dataType) for f in DELIVERY_SCHEMA
    ]
    assert d.count() == 7217  # FIXTURES.md §3 at sf0.001
    stats = d.agg(
        F.count("material").alias("materials"),
        F.sum(F.when(F.col("fecha_proceso") == "bad", 1)).alias("bad_dates"),
        F.sum(F.when(F.col("pais") == "gt", 1)).alias("lower_gt"),
    ).first()
    assert stats.materials < 7217 and stats.bad_dates > 0 and stats.lower_gt > 0


def test_landed_copy_is_reused_and_equal(spark):
    first = land_deliveries(spark, SF_SMALL)
    assert land_deliveries(spark, SF_SMALL) == first
    landed = deliveries(spark, SF_SMALL)
    derived = derive_deliveries(spark, SF_SMALL)
    assert landed.exceptAll(derived).count() == 0
    assert derived.exceptAll(landed).count() == 0


def test_fresh_landing_makes_a_new_copy(spark):
    a = land_deliveries(spark, SF_SMALL)
    b = land_deliveries(spark, SF_SMALL, fresh=True)
    assert a != b
    assert spark.read.parquet(b).count() == 7217


def test_grown_input_is_landed_anew_for_any_uri(spark, tmp_path):
    """Over a file:// folder with nested files, appended rows show at once."""
    uri = f"file://{tmp_path}/in"
    for name in ("orders", "customer"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{uri}/{name}.parquet")
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    part = F.col("l_orderkey") % 3 == 0
    lines.where(part).write.partitionBy("l_linestatus").parquet(f"{uri}/lineitem.parquet")
    before = deliveries(spark, uri).count()
    lines.where(~part).write.mode("append").partitionBy("l_linestatus").parquet(f"{uri}/lineitem.parquet")
    assert 0 < before < deliveries(spark, uri).count() == 7217


def test_landing_tasks_follow_the_rows(spark, monkeypatch):
    """A task joins and sorts a bounded part, whatever the session's number of shuffle partitions; its settings stay."""
    monkeypatch.setattr(fixture, "TASK_ROWS", 250)
    monkeypatch.setattr(fixture, "TASK_BYTES", 1)
    own = [spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", fixture.ADVISORY)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1b")
    try:
        path = land_deliveries(spark, SF_SMALL, fresh=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
    landed = spark.read.parquet(path)
    files = landed.groupBy(F.input_file_name()).count().collect()
    assert len(files) >= 20 and max(f["count"] for f in files) < 900
    assert landed.exceptAll(derive_deliveries(spark, SF_SMALL)).count() == 0 and landed.count() == 7217
    assert own == [spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", fixture.ADVISORY)]


def test_csv_copies_are_compressed_and_equal(spark):
    from cargoline.queries import _fixture_csv
    from cargoline.sources.csv import read_deliveries
    from cargoline.storage import files

    path = _fixture_csv(spark, SF_SMALL)
    assert files(spark, path) and all(f.path.endswith(".csv.lz4") for f in files(spark, path))
    assert read_deliveries(spark, path).count() == 7217
