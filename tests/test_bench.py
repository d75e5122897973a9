
import bench
from tests.conftest import SF_SMALL


def test_structural_targets(spark):
    m = bench.plan_metrics(spark, SF_SMALL)
    assert m["flagship_shuffles"] == 1
    assert m["flagship_shuffles_over_csv"] == 1
    assert m["run_input_scans"] == 1
    assert 1 <= m["run_spark_jobs"] <= 4  # the scan and the write; AQE submits their stages as jobs
