"""Summarise a Spark event log: wall time per SQL execution and per stage.

Usage: python tools/stage_times.py <event log dir or file>

Reads plain or zstd-compressed logs (Spark 4 writes ``eventlog_v2_*``
folders with ``events_*.zstd`` parts).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True))
    files = files or ([path] if os.path.isfile(path) else sorted(glob.glob(os.path.join(path, "*"))))
    for f in files:
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        yield from raw.decode().splitlines()


def main(path: str) -> None:
    sql, stages, tasks = {}, {}, {}
    for line in _lines(path):
        e = json.loads(line)
        ev = e["Event"]
        if ev.endswith("SQLExecutionStart"):
            sql[e["executionId"]] = [e["time"], None, e.get("description", "")[:50]]
        elif ev.endswith("SQLExecutionEnd"):
            sql[e["executionId"]][1] = e["time"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (
                si["Stage Name"][:40],
                si["Number of Tasks"],
                si.get("Completion Time", 0) - si.get("Submission Time", 0),
            )
        elif ev == "SparkListenerTaskEnd":
            info = e["Task Info"]
            tasks.setdefault(e["Stage ID"], []).append(info["Finish Time"] - info["Launch Time"])
    for i, (start, end, desc) in sorted(sql.items()):
        print(f"sql {i:4d} {((end or start) - start) / 1000:8.2f}s  {desc}")
    for sid, (name, n, ms) in sorted(stages.items()):
        t = sorted(tasks.get(sid, [0]))
        print(f"stage {sid:4d} {ms / 1000:8.2f}s tasks={n:5d} median={t[len(t) // 2]}ms max={t[-1]}ms  {name}")


if __name__ == "__main__":
    main(sys.argv[1])
