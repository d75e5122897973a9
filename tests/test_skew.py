"""A third of all rows on one key: the plans must split it, not funnel it."""

import os

from pyspark.sql import functions as F

from cargoline.operators.profile import cleaning_funnel, profile_values
from cargoline.plans.transform import transform
from cargoline.schema import OUTPUT_SCHEMA
from cargoline.sinks import SinkSpec, read_back, write
from cargoline.sources.fixture import deliveries

SF = "/root/testdata/sf0.01"
HOT = "19970615"


def _hot(spark):
    """sf0.01 deliveries with a third of the rows moved to one date."""
    d = deliveries(spark, SF)
    third = F.pmod(F.xxhash64(*d.columns), F.lit(3)) == 0
    return d.withColumn("fecha_proceso", F.when(third, F.lit(HOT)).otherwise(F.col("fecha_proceso")))


# Cluster-like proportions on small data: many shuffle partitions and small
# AQE targets, so the stage before the rebalance has many tasks (AQE can only
# split a hot partition between the map tasks that produced it).
SCALED = {
    "spark.sql.shuffle.partitions": "32",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


def test_hot_date_is_split_over_several_files(spark, tmp_path):
    old = {k: spark.conf.get(k, None) for k in SCALED}
    for k, v in SCALED.items():
        spark.conf.set(k, v)
    try:
        out = transform(_hot(spark), "1997-01-01", "1998-06-30")
        spec = SinkSpec(str(tmp_path / "hot"))
        write(out, spec)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

    def files(d):
        return [f for f in os.listdir(os.path.join(spec.path, d)) if f.endswith(".parquet")]

    hot = files(f"process_date={HOT}")
    assert len(hot) > 1, "the hot date must be written by several tasks"
    back = read_back(spark, spec, OUTPUT_SCHEMA)
    assert back.count() == out.count()
    assert back.filter(F.col("process_date") == HOT).count() > back.count() / 4


def test_reports_are_exact_under_skew(spark):
    hot = _hot(spark)
    vals = {r.value: r.rows for r in profile_values(hot, ["fecha_proceso"]).collect()}
    assert vals[HOT] == hot.filter(F.col("fecha_proceso") == HOT).count()
    got = {r.stage: r.rows for r in cleaning_funnel(hot, "1997-01-01", "1998-06-30").collect()}
    assert got["read"] == hot.count()
    assert got["in_date_range"] == transform(hot, "1997-01-01", "1998-06-30").count()
