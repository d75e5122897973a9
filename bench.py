"""Benchmark: run the registered queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_QUERIES (comma list, default all), BENCH_EVENT_LOG_DIR
(optional: write Spark's event log there; see tools/stage_times.py).  Every query is run to
completion through Spark's ``noop`` sink (full evaluation, nothing collected
to the driver), once, after one warm-up run of each on sf0.001.
"""

from __future__ import annotations

import contextlib
import io
import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cargoline.queries import QUERIES  # noqa: E402
from cargoline.session import local_session  # noqa: E402
from cargoline.plans.run import RunParams, run_delivery_job  # noqa: E402
from cargoline.plans.transform import transform  # noqa: E402
from cargoline.session import scratch_path  # noqa: E402
from cargoline.sinks import SinkSpec  # noqa: E402
from cargoline.sources.csv import read_deliveries  # noqa: E402
from cargoline.sources.fixture import deliveries, land_deliveries  # noqa: E402

HEADLINE = "delivery_transform"


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _count(text: str, node: str) -> int:
    return len(re.findall(rf"^\(\d+\) {node}", text, re.M))


def plan_metrics(spark, sf_dir: str) -> dict:
    """
    input scans and Spark jobs of one run of the job with its reports (from a CSV input).

    Scans are measured, not read off a plan: how often the run takes a row of its input."""
    from cargoline.queries import END, START

    flagship = plan_text(transform(deliveries(spark, sf_dir), START, END))
    csv_path = scratch_path(spark, "bench-csv")
    deliveries(spark, sf_dir).write.option("header", True).option("quote", '"').option(
        "escape", '"'
    ).csv(csv_path)
    source = read_deliveries(spark, csv_path)
    over_csv = plan_text(transform(source, START, END))
    params = RunParams(START, END, output=SinkSpec(scratch_path(spark, "bench-run")))
    rows, taken = source.count(), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            taken.add(b.num_rows)
            yield b

    again = RunParams(START, END, output=SinkSpec(scratch_path(spark, "bench-scans")))
    measured = run_delivery_job(source.mapInArrow(counted, source.schema), again)
    measured.funnel().collect(), measured.input_info, measured.metrics().collect()
    tracker = spark.sparkContext.statusTracker()
    group = f"bench-run-{time.time_ns()}"
    spark.sparkContext.setJobGroup(group, "one run of the delivery job")
    run_delivery_job(source, params)
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    return {
        "flagship_shuffles": _count(flagship, "Exchange"),
        "flagship_shuffles_over_csv": _count(over_csv, "Exchange"),
        "run_input_scans": taken.value / rows if rows else 0,
        "run_spark_jobs": jobs,
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    names = [n for n in wanted.split(",") if n] if wanted else sorted(QUERIES)
    spark = local_session(
        cpus,
        shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16,
        event_log_dir=os.environ.get("BENCH_EVENT_LOG_DIR"),
    )
    # Warm-up: JVM start, JIT and whole-stage code generation (generated code
    # is cached by its text, which does not depend on the data size), by
    # running every query once on the smallest table set next to sf_dir.
    small = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    warm_dir = small if os.path.isdir(small) else sf_dir
    land_deliveries(spark, warm_dir, fresh=True)
    for name in names:
        run(spark, name, warm_dir)
    # The queries read the deliveries table landed once as Parquet; building
    # it (three-table join + write) is timed as an entry of its own.
    t0 = time.perf_counter()
    land_deliveries(spark, sf_dir, fresh=True)
    times = {"land_deliveries": round(time.perf_counter() - t0, 3)}
    times.update({name: round(run(spark, name, sf_dir), 3) for name in names})
    plans = plan_metrics(spark, sf_dir)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "headline": {HEADLINE: times.get(HEADLINE)},
                "cpus": cpus,
                "warmup": f"the landing and each query once on {warm_dir}",
                "plan": plans,
                # caching nothing, each one re-reads the input CSV.
                "baseline_plan": {"run_spark_actions": 16, "run_input_scans": 16},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
