"""Summarise a Spark event log per job group (bench.py names groups by query).

Usage: python scripts/eventlog_summary.py <event-log-file-or-folder>
Prints per query: jobs, stages, tasks, summed stage wall time, summed task
time, shuffle bytes written and the slowest stage.
"""

import json
import os
import sys
from collections import defaultdict


def events(path):
    if os.path.isfile(path):
        files = [path]
    else:  # a folder of logs, or Spark 4 rolling logs (eventlog_v2_*/events_*)
        files = sorted(os.path.join(base, f) for base, _, names in os.walk(path)
                       for f in names if not f.startswith(("appstatus", ".")))
    for f in files:
        with open(f, "rb") as raw:
            if f.endswith(".zstd"):
                import zstandard
                reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
                data = reader.read()
            else:
                data = raw.read()
        for line in data.decode("utf-8").splitlines():
            if line.strip():
                yield json.loads(line)


def main():
    stage_group, job_group = {}, {}
    stats = defaultdict(lambda: {"jobs": 0, "stages": 0, "tasks": 0, "stage_ms": 0,
                                 "task_ms": 0, "shuffle_write": 0, "slowest": (0, "")})
    for ev in events(sys.argv[1]):
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "-")
            job_group[ev["Job ID"]] = group
            stats[group]["jobs"] += 1
            for sid in ev.get("Stage IDs", []):
                stage_group[sid] = group
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            group = stage_group.get(info["Stage ID"], "-")
            if "Completion Time" not in info or "Submission Time" not in info:
                continue
            ms = info["Completion Time"] - info["Submission Time"]
            s = stats[group]
            s["stages"] += 1
            s["tasks"] += info.get("Number of Tasks", 0)
            s["stage_ms"] += ms
            if ms > s["slowest"][0]:
                s["slowest"] = (ms, info.get("Stage Name", "")[:60])
        elif kind == "SparkListenerTaskEnd":
            group = stage_group.get(ev.get("Stage ID"), "-")
            m = ev.get("Task Metrics") or {}
            stats[group]["task_ms"] += m.get("Executor Run Time", 0)
            stats[group]["shuffle_write"] += (m.get("Shuffle Write Metrics") or {}).get(
                "Shuffle Bytes Written", 0)
    print(f"{'query':20s} {'jobs':>4s} {'stg':>4s} {'tasks':>6s} {'stage_ms':>9s} "
          f"{'task_ms':>8s} {'shufKB':>8s}  slowest stage")
    for group, s in sorted(stats.items(), key=lambda kv: -kv[1]["stage_ms"]):
        print(f"{group:20s} {s['jobs']:4d} {s['stages']:4d} {s['tasks']:6d} {s['stage_ms']:9d} "
              f"{s['task_ms']:8d} {s['shuffle_write'] // 1024:8d}  "
              f"{s['slowest'][0]}ms {s['slowest'][1]}")


if __name__ == "__main__":
    main()
