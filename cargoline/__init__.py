"""cargoline: product-delivery analytics on Spark DataFrames.

Every operator is a ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; actions run only in sinks and in explicit
reporting helpers.  See README.md.
"""

from cargoline.plans.run import RunParams, RunResult, run_delivery_job, run_delivery_job_from_csv
from cargoline.plans.transform import DeliveryRules, QualityChecks, transform
from cargoline.sinks import SinkSpec, read_back, write, write_by_date
from cargoline.sources.csv import read_csv, read_deliveries

__all__ = [
    "DeliveryRules",
    "QualityChecks",
    "RunParams",
    "RunResult",
    "SinkSpec",
    "read_back",
    "read_csv",
    "read_deliveries",
    "run_delivery_job",
    "run_delivery_job_from_csv",
    "transform",
    "write",
    "write_by_date",
]
