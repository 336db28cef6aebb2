"""Rows read vs rows and bytes shuffled, per registered query.

Runs the given queries with Spark's event log (uncompressed) in a fresh
scratch folder, then sums the task metrics of the jobs submitted while each
query ran -- stream micro-batches included, which run on their own thread.

    python scripts/shuffle_report.py <sf_dir> <log_dir> name [name ...]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowtally.queries import QUERIES  # noqa: E402
from flowtally.session import build_session  # noqa: E402


def main() -> None:
    sf_dir, log_dir, names = sys.argv[1], sys.argv[2], sys.argv[3:]
    spark = build_session("local[8]", 8, conf={"spark.eventLog.enabled": "true",
                                               "spark.eventLog.compress": "false",
                                               "spark.eventLog.dir": log_dir})
    spans = []
    for name in names:
        t0 = time.time() * 1000
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spans.append((name, t0, time.time() * 1000))
    spark.stop()
    apps = sorted(glob.glob(f"{log_dir}/*"), key=os.path.getmtime)
    files = (sorted(glob.glob(f"{apps[-1]}/events_*")) if os.path.isdir(apps[-1])
             else [apps[-1]])
    job_query, stage_job, totals = {}, {}, {}
    for path in files:
        for line in open(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                at = ev.get("Submission Time", 0)
                job_query[ev["Job ID"]] = next((n for n, a, b in spans if a <= at <= b), None)
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = ev["Job ID"]
            elif kind == "SparkListenerTaskEnd":
                q = job_query.get(stage_job.get(ev["Stage ID"]))
                m = ev.get("Task Metrics") or {}
                t = totals.setdefault(q, [0, 0, 0])
                t[0] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                w = m.get("Shuffle Write Metrics") or {}
                t[1] += w.get("Shuffle Records Written", 0)
                t[2] += w.get("Shuffle Bytes Written", 0)
    print("| query | rows read | rows shuffled | bytes shuffled |")
    print("| --- | --- | --- | --- |")
    for name in names:
        r, sr, sb = totals.get(name, [0, 0, 0])
        print(f"| `{name}` | {r:,} | {sr:,} | {sb:,} |")


if __name__ == "__main__":
    main()
