"""Write PLANS.md: the physical plan shape of every registered query.

Usage: python tools/plan_report.py [sf_dir]

For each query: shuffles (``Exchange``), broadcasts, file scans, Python
evaluation nodes, and the filters pushed into each scan; then the full formatted plans of the flagship and the one-pass reports.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cargoline.queries import END, QUERIES, START  # noqa: E402
from cargoline.session import local_session  # noqa: E402

FULL = ("delivery_transform", "cleaning_funnel", "profile_values", "audit_bad_dates")


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def shape(text: str) -> dict:
    nodes = re.findall(r"^\(\d+\) (.+?)\s*$", text, re.M)
    pushed = re.findall(r"^PushedFilters: \[(.*)\]$", text, re.M)
    partition = re.findall(r"^PartitionFilters: \[(.*)\]$", text, re.M)
    return {
        "shuffles": sum(n.startswith("Exchange") for n in nodes),
        "broadcasts": sum(n.startswith("BroadcastExchange") for n in nodes),
        "scans": sum(n.startswith("Scan") for n in nodes),
        "python": sum("EvalPython" in n or "FlatMapGroupsInPandas" in n for n in nodes),
        "pushed": [p for p in pushed if p],
        "partition": [p for p in partition if p],
    }


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    lines = [
        "# Physical plans",
        "",
        f"Generated by `tools/plan_report.py` on `{sf_dir}` (local[8], AQE on; "
        "initial plans, before AQE's runtime changes). Sink and source queries "
        "show the plan of reading their written files back.",
        "",
        "Reports with more than one shuffle (`cleaning_funnel`, `output_summary`, "
        "`rows_per_partition`, `profile_rows`) aggregate twice: after the "
        "partial + final aggregation of the rows, the second shuffle carries only "
        "per-task partial counts (a `SinglePartition` exchange of a few longs, or "
        "one `(date, count)` record per date and task).",
        "",
        "| query | shuffles | broadcasts | scans | python nodes | pushed filters |",
        "| --- | --- | --- | --- | --- | --- |",
    ]
    full = {}
    for name in sorted(QUERIES):
        text = formatted(QUERIES[name](spark, sf_dir))
        s = shape(text)
        filters = "; ".join(s["pushed"] + [f"partition: {p}" for p in s["partition"]]) or "—"
        lines.append(
            f"| `{name}` | {s['shuffles']} | {s['broadcasts']} | {s['scans']} | "
            f"{s['python']} | {filters} |"
        )
        if name in FULL:
            full[name] = text
    from cargoline.plans.transform import transform
    from cargoline.sources.fixture import derive_deliveries

    full["deliveries derivation (landed once)"] = formatted(derive_deliveries(spark, sf_dir))
    full["run job write input (rebalanced on process_date)"] = formatted(
        transform(derive_deliveries(spark, sf_dir), START, END).hint("rebalance", "process_date")
    )
    for name, text in full.items():
        lines += ["", f"## {name}", "", "```", text.strip(), "```"]
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    print(out)


if __name__ == "__main__":
    main(sys.argv)
