"""Per-stage task balance from a Spark event log.

Reads the JSON event log written when ``VISITFLOW_EVENT_LOG_DIR`` is set (a
plain file, or Spark 4's rolling ``eventlog_v2_*`` folder of zstd-compressed
``events_*`` files) and prints, for the stages with the most skewed tasks, the task count, median and
largest task run time, and median and largest records read per task (input
plus shuffle). Usage: python tools/task_skew.py <event log file or folder> [top]
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
from collections import defaultdict


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        if f.endswith(".zstd") or f.endswith(".zst"):
            import zstandard
            with open(f, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(f, encoding="utf-8") as fh:
                yield from fh


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    runs: dict[tuple, list] = defaultdict(list)
    recs: dict[tuple, list] = defaultdict(list)
    names: dict[tuple, str] = {}
    for line in _lines(path):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerTaskEnd" and ev.get("Task Metrics"):
            key = (ev["Stage ID"], ev["Stage Attempt ID"])
            m = ev["Task Metrics"]
            runs[key].append(m.get("Executor Run Time", 0))
            rec = m.get("Input Metrics", {}).get("Records Read", 0)
            rec += m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            recs[key].append(rec)
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            names[(info["Stage ID"], info["Stage Attempt ID"])] = info["Stage Name"].split(" at ")[0]
    rows = []
    for key, r in runs.items():
        rc = recs[key]
        total = sum(rc)
        if len(r) < 2 or total < 1000:  # single-task or trivial stages say nothing about balance
            continue
        rows.append((max(rc) / total, key, len(r), statistics.median(r), max(r), statistics.median(rc), max(rc), total))
    rows.sort(reverse=True)
    print("| stage | tasks | median ms | max ms | median records | max records | largest task share of records |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for share, key, n, med, mx, mrec, xrec, total in rows[:top]:
        print(f"| {key[0]} {names.get(key, '')} | {n} | {med:.0f} | {mx} | {mrec:.0f} | {xrec} | {share:.3f} |")


if __name__ == "__main__":
    main()
